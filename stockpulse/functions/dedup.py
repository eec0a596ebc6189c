"""Duplicate rows by digests.

Every row has a digest of 128 bits.  Counting digests moves 16 bytes a row
instead of the whole row; only rows whose digest occurs more than once are
compared in full, so two rows that share a digest by chance are both kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpulse.session import materialize

BROADCAST_DIGESTS = 1_000_000     # repeated digests (16 bytes each), or words of 64 bits for more of them, that are sent to every task

Digest = Callable[[list[str]], tuple[Column, Column]]


def row_digest(columns: list[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of all columns, the places of nulls included."""
    cols = [F.col(f"`{c}`") for c in columns]
    nulls = F.concat(*[F.col(f"`{c}`").isNull().cast("int").cast("string") for c in columns])
    return F.xxhash64(nulls, *cols), F.xxhash64(F.lit("second"), *reversed(cols), nulls)


def _digested(df: DataFrame, digest: Digest) -> tuple[DataFrame, DataFrame]:
    """``df`` with its digest, and the digests with their row counts."""
    high, low = digest(df.columns)
    rows = df.withColumns({"_high": high, "_low": low})
    return rows, rows.groupBy("_high", "_low").agg(F.count(F.lit(1)).alias("_n"))


def distinct_rows(df: DataFrame, digest: Digest = row_digest, broadcast_digests: int = BROADCAST_DIGESTS) -> DataFrame:
    """The distinct rows of ``df`` (nulls equal each other).

    For rows read from storage: they are read twice, but unique ones are never
    shuffled.  The repeated digests are written, counted, and broadcast if
    they are few; if they are many, each sets a bit in a table of as many
    words, and rows whose bit is not set are unique.  The others are compared
    in full: every copy of a row is among them, and by chance some unique
    ones.  Rows that already lie together by a column (a join's output) are
    better served by ``dropDuplicates``.
    """
    rows, counts = _digested(df, digest)
    repeated = materialize(counts.where(F.col("_n") > 1).select("_high", "_low"), "repeated-digests")
    if repeated.count() > broadcast_digests:
        word, bit = F.pmod("_high", F.lit(max(1, broadcast_digests))), "cast(pmod(_low, 64) as int)"
        words = repeated.groupBy(word.alias("_word")).agg(F.expr(f"bit_or(shiftleft(1L, {bit}))").alias("_bits"))
        marked = rows.withColumn("_word", word).join(F.broadcast(words), "_word", "left")
        again, own = F.coalesce(F.expr(f"shiftright(_bits, {bit}) & 1L"), F.lit(0)) == 1, [F.col(f"`{c}`") for c in df.columns]
        return marked.where(~again).select(*own).unionAll(marked.where(again).select(*own).dropDuplicates())
    few = F.broadcast(repeated)
    unique = rows.join(few, ["_high", "_low"], "left_anti").drop("_high", "_low")
    return unique.unionAll(rows.join(few, ["_high", "_low"], "left_semi").drop("_high", "_low").dropDuplicates())


def distinct_count(df: DataFrame, digest: Digest = row_digest) -> Column:
    """The number of distinct rows, as a scalar: digests that occur once, and the distinct rows behind the others."""
    rows, counts = _digested(df, digest)
    once = counts.select(F.count_if(F.col("_n") == 1)).scalar()
    repeated = counts.where(F.col("_n") > 1).select("_high", "_low")
    again = rows.join(repeated, ["_high", "_low"], "left_semi").drop("_high", "_low").distinct().select(F.count(F.lit(1))).scalar()
    return once + again
