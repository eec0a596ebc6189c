"""Helpers shared by the corpus operators."""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from typing import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key_crc32(col: str) -> Column:
    """Unsigned crc32 of a key written as text (null for a null key)."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def uniform(*cols) -> Column:
    """A double in [0, 1) that depends only on the given values (nulls count as a value)."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(float(1 << 53))


def with_outputs(df: DataFrame, outputs: dict[str, Column]) -> DataFrame:
    """Add output columns; an input column of the same name (in any case) is replaced."""
    taken = {c.lower() for c in outputs}
    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*rest, *[c.alias(n) for n, c in outputs.items()])


@lru_cache(maxsize=1)
def category_table() -> np.ndarray:
    """For each code point: 1 letter, 2 number, 0 anything else."""
    first = {"L": 1, "N": 2}
    return np.fromiter((first.get(unicodedata.category(chr(i))[0], 0) for i in range(0x110000)), np.uint8, 0x110000)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def in_slices(texts: list[str], chars: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges of about ``chars`` characters (one text at least), which bounds working memory."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > chars:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


@lru_cache(maxsize=1)
def _spaces() -> np.ndarray:
    return np.fromiter((chr(i).isspace() for i in range(0x3001)), bool, 0x3001)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: list[str], alphanumeric: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in lower case, and each word's text number.

    Words are split at white space, or are runs of letters and numbers.
    """
    lowered = [t.lower() for t in texts]
    ends = np.cumsum([len(t) + 1 for t in lowered])
    codes = code_points("\n" + "\n".join(lowered) + "\n")
    if alphanumeric:
        inside = category_table()[codes] > 0
    else:
        inside = ~_spaces()[np.minimum(codes, 0x3000)] | (codes > 0x3000)
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(~inside[at - 1])
    place = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    powers = np.cumprod(np.full(place.max() + 1, 0x9E3779B97F4A7C15, np.uint64))
    h = np.add.reduceat(mix(codes[at].astype(np.uint64) + np.uint64(1)) * powers[place], first)
    return mix(h), np.searchsorted(ends, at[first] - 1, side="right")
