"""Exact order statistics without ordering the rows.

Every wanted rank has a *region* of the order that is known to hold it.  A
pass of mergeable quantile sketches (``approx_percentile``) proposes a bracket
around each rank, a counting pass says how many rows lie before and inside it
and so proves or corrects it, and once few rows are left these alone are
ordered.  One pass serves all measures and ranks; nothing is written.  Each
task sends sketches, counts or the few rows of the last brackets, so hot
values, however many rows share them, cost nothing: equal values are told
apart by further keys of the tie-break (text six bytes at a time).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDERED_ROWS = 10_000     # a region of at most so many rows is ordered
ACCURACY = 10_000         # a sketch's rank is off by at most 1 / ACCURACY of the rows
CHUNK = 6                 # bytes of text that make one key


@dataclass
class Region:
    """Where the row of one rank lies: equal to ``prefix`` in the first keys, above ``lo`` and up to ``hi`` in the next."""
    measure: str
    rank: int                                  # within the region, from 1
    rows: int
    prefix: list = field(default_factory=list)
    lo: Any = None                             # excluded; None: open
    hi: Any = None                             # included
    bracket: tuple | None = None

    def holds(self, keys: list[Column]) -> Column:
        parts = [k == F.lit(v) for k, v in zip(keys, self.prefix)]
        key = keys[len(self.prefix)] if len(self.prefix) < len(keys) else None
        if key is not None:
            parts.append(key.isNotNull())
            if self.lo is not None:
                parts.append(key > F.lit(self.lo))
            if self.hi is not None:
                parts.append(key <= F.lit(self.hi))
        return reduce(lambda a, b: a & b, parts)


def _keys(df: DataFrame, value: str, tie: str | None, longest: int) -> list[Column]:
    keys = [F.col(f"`{value}`")]
    if tie is not None and df.schema[tie].dataType.simpleString() == "string":
        raw = F.col(f"`{tie}`").cast("binary")
        for at in range(0, longest, CHUNK):
            digits = F.rpad(F.hex(F.substring(raw, at + 1, CHUNK)), 2 * CHUNK, "0")
            keys.append(F.conv(digits, 16, 10).cast("bigint"))
    elif tie is not None:
        keys.append(F.col(f"`{tie}`"))
    return keys


def select_ranks(df: DataFrame, measures: list[str], ranks: Callable[[int], list[int]], tie: str | None = None,
                 ordered_rows: int = ORDERED_ROWS) -> dict[str, list[tuple]]:
    """For each measure, the (value, tie-break) at every rank that ``ranks`` names for its number of values.

    Nulls are no values; a measure without values has no ranks.  Ranks count
    from 1 in ascending order by value, then ``tie`` (which should be unique
    among equal values; without it only values are told apart, and the
    tie-break is null).  The result does not depend on partitions.
    """
    text_tie = tie is not None and df.schema[tie].dataType.simpleString() == "string"
    first = df.agg(*[F.count(F.col(f"`{m}`")).alias(f"n{i}") for i, m in enumerate(measures)],
                   (F.max(F.octet_length(F.col(f"`{tie}`"))) if text_tie else F.lit(0)).alias("longest")).first()
    keys = {m: _keys(df, m, tie, first["longest"] or 0) for m in measures}
    asked = {m: list(ranks(first[f"n{i}"])) if first[f"n{i}"] else [] for i, m in enumerate(measures)}
    regions = [Region(m, r, first[f"n{i}"]) for i, m in enumerate(measures) for r in sorted(set(asked[m]))]
    names = [(r.measure, r.rank) for r in regions]
    while True:
        wide = [r for r in regions if r.rows > ordered_rows and len(r.prefix) < len(keys[r.measure])]
        if not wide:
            break
        _bracket(df, keys, wide)
        _count(df, keys, wide)
    found = dict(zip(names, _order(df, keys, regions, tie)))
    return {m: [found[m, r] for r in asked[m]] for m in measures}


def _bracket(df: DataFrame, keys: dict[str, list[Column]], regions: list[Region]) -> None:
    """Propose a bracket for every rank, from one pass of sketches."""
    slack = 2 / ACCURACY
    wanted = []
    for i, r in enumerate(regions):
        at = r.rank / r.rows
        key = F.when(r.holds(keys[r.measure]), keys[r.measure][len(r.prefix)])
        wanted.append(F.approx_percentile(key, [max(0.0, at - slack), min(1.0, at + slack)], ACCURACY).alias(f"b{i}"))
    row = df.agg(*wanted).first()
    for i, r in enumerate(regions):
        r.bracket = tuple(row[f"b{i}"])


def _count(df: DataFrame, keys: dict[str, list[Column]], regions: list[Region]) -> None:
    """Count the rows before, at the lower end of, inside and at the upper end of every bracket, and narrow the regions."""
    wanted = []
    for i, r in enumerate(regions):
        key, here, (lo, hi) = keys[r.measure][len(r.prefix)], r.holds(keys[r.measure]), r.bracket
        for name, part in (("before", key < F.lit(lo)), ("low", key == F.lit(lo)), ("upto", key <= F.lit(hi)), ("high", key == F.lit(hi))):
            wanted.append(F.count_if(here & part).alias(f"{name}{i}"))
    row = df.agg(*wanted).first()
    for i, r in enumerate(regions):
        (lo, hi), before, low, upto, high = r.bracket, row[f"before{i}"], row[f"low{i}"], row[f"upto{i}"], row[f"high{i}"]
        if r.rank <= before:                           # below the bracket: beyond the sketch's bound
            r.hi, r.rows = _below(lo, r), before
        elif r.rank <= before + low:
            r.prefix, r.rank, r.rows, r.lo, r.hi = [*r.prefix, lo], r.rank - before, low, None, None
        elif upto - high < r.rank <= upto:
            r.prefix, r.rank, r.rows, r.lo, r.hi = [*r.prefix, hi], r.rank - (upto - high), high, None, None
        elif r.rank <= upto:
            r.rank, r.rows, r.lo, r.hi = r.rank - before - low, upto - before - low, lo, hi
        else:
            r.rank, r.rows, r.lo = r.rank - upto, r.rows - upto, hi


def _below(value: Any, region: Region) -> Any:
    """An upper end just under ``value``."""
    import math

    if isinstance(value, float):
        return math.nextafter(value, -math.inf)
    if isinstance(value, int):
        return value - 1
    raise TypeError(f"{region.measure}: values of type {type(value).__name__} cannot be selected; cast them to double or bigint")


def _order(df: DataFrame, keys: dict[str, list[Column]], regions: list[Region], tie: str | None) -> list[tuple]:
    """The rows themselves: each region is small, or all its rows are equal in every key."""
    if not regions:
        return []
    wanted = []
    for i, r in enumerate(regions):
        pair = F.struct(keys[r.measure][0].alias("v"), (F.col(f"`{tie}`") if tie is not None else F.lit(None).cast("int")).alias("t"))
        here = F.when(r.holds(keys[r.measure]), pair)
        settled = len(r.prefix) == len(keys[r.measure])
        wanted.append((F.min(here) if settled else F.get(F.sort_array(F.collect_list(here)), F.lit(r.rank - 1))).alias(f"r{i}"))
    row = df.agg(*wanted).first()
    return [(row[f"r{i}"]["v"], row[f"r{i}"]["t"]) for i in range(len(regions))]


def median_ranks(n: int) -> list[int]:
    return [(n + 1) // 2, (n + 2) // 2]


def exact_medians(df: DataFrame, values: list[str], ordered_rows: int = ORDERED_ROWS) -> dict[str, float | None]:
    """The exact median of every column (nulls left out; None where there is no value), all from the same passes."""
    narrow = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in values])
    found = select_ranks(narrow, values, median_ranks, ordered_rows=ordered_rows)
    return {c: (sum(v for v, _ in found[c]) / 2 if found[c] else None) for c in values}
