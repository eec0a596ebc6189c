"""Sharding by sampled splitters: shards of near-equal bytes, equal texts side by side.

Rows are ordered by (hash of the text, hash of the key, key).  A sample in
which a row's chance follows its size gives quantile splitters of the text
hash, a bounded number of them; rows are range-partitioned by these.  Exact
counts then show which ranges are overfull.  They are subdivided in the same
order: evenly by the text hash, of which each text has one, so that copies
stay side by side however many rows there are.  A text that alone overfills a
range leaves it for ranges of its own, divided by the hash of the key, and
where one key repeats, by the place its rows were read from.

Running sums in two levels (over the splitters' ranges, which are bounded in
number, then inside each over its subdivisions) and a window inside each
subdivision give every row its exact position in bytes, from which its shard
and slot follow.  No window or task holds more than a subdivision's rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpulse.llm.common import uniform
from stockpulse.session import materialize

RANGES = 4_096            # splitters' ranges, at most
SAMPLE_PER_RANGE = 16
BROADCAST_ROWS = 50_000   # hot texts and subdivisions that are sent to every task; more are joined by a shuffle


def text_size(text: str) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)) + 1).cast("long")


def _splitters(rows: DataFrame, n_ranges: int, total: int, seed: int) -> list[float]:
    """Distinct quantiles of ``_k`` in a sample whose inclusion chance is proportional to the size.

    At most about ``RANGES * SAMPLE_PER_RANGE`` doubles reach the driver.
    """
    rate = n_ranges * SAMPLE_PER_RANGE / max(total, 1)
    # a row of size s stands in the sample with weight s * rate: whole copies, and one more by chance
    weight = F.floor(F.col("size") * rate + uniform(F.lit(seed), F.col("_k"), F.col("_u"))).cast("int")
    drawn = rows.select("_k", weight.alias("w")).where("w > 0").groupBy("_k").agg(F.sum("w").alias("w")).orderBy("_k").collect()
    if not drawn:
        return []
    keys, upto = np.array([r["_k"] for r in drawn]), np.cumsum([r["w"] for r in drawn])
    at = np.searchsorted(upto, np.arange(1, n_ranges) * upto[-1] / n_ranges, side="left")
    return np.unique(keys[at]).tolist()


def _sized(df: DataFrame, label: str) -> DataFrame:
    """A written table, to be broadcast if it has few rows."""
    table = materialize(df, label)
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def shard_by_bytes(docs: DataFrame, n_shards: int = 16, text: str = "text", key: str = "doc_id",
                   rows_per_range: int = 20_000, tolerance: float = 0.05, seed: int = 11, max_ranges: int = RANGES) -> DataFrame:
    """Key, ``size``, ``text_crc32``, ``shard``, ``slot`` and ``start`` (bytes before the row) of every row.

    Shard ``i`` takes the rows whose middle byte lies in the i-th of
    ``n_shards`` equal stretches.  Equal texts follow each other in the order;
    a group of at most ``2 * tolerance`` of a shard stays whole (it goes by the
    group's middle), a larger one may be divided where a shard is full.
    ``slot`` numbers a shard's rows from 0 without gaps.

    A null text has size 1 and no crc (null); a null key is ordered by its
    hash like any other; repeated rows each get a slot of their own, in any
    order among themselves; an empty table gives an empty result.  Other
    columns of the input are not returned.
    """
    t, k = F.col(f"`{text}`"), F.col(f"`{key}`")
    rows = materialize(docs.select(
        k.alias("_key"), text_size(text).alias("size"), F.crc32(t.cast("binary")).alias("text_crc32"), uniform(F.lit(seed), t).alias("_k"),
        F.xxhash64(F.lit(seed), t.isNull(), t).alias("_h"), uniform(F.lit(seed + 1), k).alias("_u"), F.monotonically_increasing_id().alias("_id")), "shard-rows")
    counted = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("total")).first()
    total = counted["total"]
    n_ranges = min(max_ranges, max(n_shards * 4, -(-counted["n"] // rows_per_range)))
    edges = [-1.0, *[x for x in _splitters(rows, n_ranges, total, seed) if 0 < x], 2.0]
    ranged = Bucketizer(splits=edges if len(edges) > 2 else [-1.0, 0.5, 2.0], inputCol="_k", outputCol="_r").transform(rows).withColumn("_r", F.col("_r").cast("int"))

    # texts with more rows than a range: their parts go by the key's hash
    hot = _sized(rows.groupBy("_k", "_h").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("_hot_bytes")).where(F.col("n") > rows_per_range)
                 .select("_k", "_h", "_hot_bytes", F.ceil(F.col("n") / rows_per_range).alias("_hot_parts")), "hot-texts")
    ranged = ranged.join(hot, ["_k", "_h"], "left").withColumn("_hot", F.col("_hot_parts").isNotNull())
    # overfull ranges, at most max_ranges: parts of equal width of the text hash
    full = ranged.where(~F.col("_hot")).groupBy("_r").agg(F.count(F.lit(1)).alias("n"), F.min("_k").alias("_lo"), F.max("_k").alias("_hi"))
    full = full.select("_r", "_lo", "_hi", F.ceil(F.col("n") / rows_per_range).alias("_parts"))
    ranged = ranged.join(F.broadcast(full), "_r", "left")
    width = F.greatest(F.col("_hi") - F.col("_lo"), F.lit(1e-300))
    part = F.least(F.col("_parts") - 1, F.floor((F.col("_k") - F.col("_lo")) / width * F.col("_parts")))
    ranged = ranged.select(
        "_key", "size", "text_crc32", "_k", "_h", "_u", "_id", "_r", "_hot", "_hot_bytes",
        F.when(F.col("_hot"), F.col("_h")).otherwise(F.lit(0)).alias("_text"),
        F.when(F.col("_hot"), F.floor(F.col("_u") * F.col("_hot_parts"))).otherwise(part).alias("_sub"))
    # a hot text's part that is overfull even so repeats one key: its rows are divided by the place they were read from
    where = ["_r", "_hot", "_text", "_sub"]
    again = _sized(ranged.where("_hot").groupBy(*where).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * rows_per_range)
                   .select(*where, F.lit(True).alias("_again")), "repeated-keys")
    ranged = ranged.join(again, where, "left").withColumn("_place", F.when(F.col("_again"), F.shiftright("_id", 33)).otherwise(F.lit(-1))).drop("_again")

    where = [*where, "_place"]
    parts = materialize(ranged.groupBy(*where).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")), "shard-ranges")
    # hot texts stand behind the other rows of their range; the outer sums run over the ranges, the inner ones inside each
    before = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    outer = parts.groupBy("_r").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).select(
        F.col("_r").alias("_or"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_n0"), F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("_b0"))
    order = Window.partitionBy("_r").orderBy("_hot", "_text", "_sub", "_place").rowsBetween(Window.unboundedPreceding, -1)
    inner = parts.select(*where, F.coalesce(F.sum("n").over(order), F.lit(0)).alias("_n1"), F.coalesce(F.sum("bytes").over(order), F.lit(0)).alias("_b1"))
    offsets = inner.join(F.broadcast(outer), F.col("_r") == F.col("_or")).select(*where, (F.col("_n0") + F.col("_n1")).alias("_rows_before"), (F.col("_b0") + F.col("_b1")).alias("_bytes_before"))
    offsets = offsets.withColumn("_text_from", F.min(F.when(F.col("_hot"), F.col("_bytes_before"))).over(Window.partitionBy("_r", "_hot", "_text")))
    offsets = _sized(offsets, "shard-offsets")

    inside = Window.partitionBy(*where).orderBy("_k", "_h", "_u", "_key", "_id")
    same = Window.partitionBy(*where, "_k", "_h")
    at = (ranged.withColumn("_row", F.row_number().over(inside))
          .withColumn("_upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
          .withColumn("_group", F.sum("size").over(same))
          .withColumn("_group_start", F.min(F.col("_upto") - F.col("size")).over(same))
          .join(offsets, where))
    start = F.col("_bytes_before") + F.col("_upto") - F.col("size")
    group = F.coalesce(F.col("_hot_bytes"), F.col("_group"))
    group_start = F.when(F.col("_hot"), F.col("_text_from")).otherwise(F.col("_bytes_before") + F.col("_group_start"))
    whole = group <= F.lit(2 * tolerance * total / n_shards)
    middle = F.when(whole, group_start + group / 2).otherwise(start + F.col("size") / 2)
    placed = at.select(
        F.col("_key").alias(key), "size", "text_crc32", start.alias("start"), (F.col("_rows_before") + F.col("_row") - 1).alias("_rank"),
        F.least(F.lit(n_shards - 1), F.floor(middle * n_shards / max(total, 1))).cast("int").alias("shard"))
    placed = materialize(placed, "shards")
    first = placed.groupBy("shard").agg(F.min("_rank").alias("_first"))  # n_shards rows
    return placed.join(F.broadcast(first), "shard").select(
        key, "size", "text_crc32", "shard", (F.col("_rank") - F.col("_first")).alias("slot"), "start")
