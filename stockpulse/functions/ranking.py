"""Exact global ranks and quantile buckets without a single-task window.

``row_number().over(Window.orderBy(...))`` moves every row into one task.
Instead: range-partition on the full ordering key (value + unique
tie-break), sort inside each partition, number rows locally, and add the
count of all rows in earlier partitions.  Range partitioning also splits a
hot value across partitions because the tie-break column is unique.

The numbered frame is checkpointed (reliable checkpoint in
``spark.checkpoint.dir``) before the offsets are computed, so the
sample-based range boundaries cannot change between the two passes, and an
executor loss recomputes from the checkpoint rather than re-sampling.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpulse.functions.selection import exact_medians
from stockpulse.session import ensure_checkpoint_dir, materialize


def global_row_number(df: DataFrame, order_cols: list, out_col: str = "rn",
                      num_partitions: int | None = None, total_col: str | None = None) -> DataFrame:
    """1-based row number over ``order_cols`` (which must define a total order).

    With ``total_col`` the total row count is attached as well.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = (df.repartitionByRange(n, *order_cols)
                  .sortWithinPartitions(*order_cols)
                  .withColumn("_pid", F.spark_partition_id())
                  # monotonically_increasing_id = (partition index << 33) + position
                  .withColumn("_pos", F.monotonically_increasing_id()
                              - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)))
    numbered = materialize(numbered, "ranked")
    counts = numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # one row per partition: a bounded broadcast
    offsets = counts.select("_pid", (F.sum("_cnt").over(Window.orderBy("_pid")) - F.col("_cnt")).alias("_off"),
                            F.sum("_cnt").over(Window.partitionBy()).alias("_tot"))
    out = (numbered.join(F.broadcast(offsets), "_pid")
                   .withColumn(out_col, F.col("_off") + F.col("_pos") + 1))
    if total_col:
        out = out.withColumnRenamed("_tot", total_col)
    return out.drop("_pid", "_pos", "_off", "_tot")


def keep_best(df: DataFrame, keys: list[str], order: str, largest: bool = True) -> DataFrame:
    """The rows with the largest (or smallest) ``order`` of their key, in the columns of ``df``; null keys are keys.

    The best order of each key is found by a hash aggregate over fixed-width
    values (``order`` must be a number, date or timestamp), combined before
    the shuffle, and joined back; whole rows are neither sorted nor held in
    aggregation buffers.  Rows that share key and order all stay; rows with a
    null order go.
    """
    best = (F.max if largest else F.min)(F.col(f"`{order}`"))
    found = df.groupBy(*[F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)]).agg(best.alias("_best"))
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)] + [F.col(f"`{order}`") == F.col("_best")]
    return df.join(found, reduce(lambda a, b: a & b, same), "left_semi")


def exact_median(df: DataFrame, value: str) -> Column:
    """The exact median of a column (nulls left out; null if there is none), by selection (``functions.selection``)."""
    return F.lit(exact_medians(df, [value])[value]).cast("double")


def bucket_by_edges(value: str, tie: str, edges: list[tuple]) -> Column:
    """1 + the number of edges before the row in the order by value and tie-break."""
    out = F.lit(1)
    for v, t in edges:
        out = out + ((F.col(value) > F.lit(v)) | ((F.col(value) == F.lit(v)) & (F.col(tie) > F.lit(t)))).cast("int")
    return out.cast("int")


def qcut_ranks(n: int, q: int = 5) -> list[int]:
    """The last rank of every bucket but the last, as equal-frequency cutting of ranks 1..n gives them."""
    return [1 + (n - 1) * k // q for k in range(1, q)]


def qcut_bucket(rn: str, n: str, q: int = 5):
    """Bucket (1..q) that equal-frequency cutting of ranks 1..n assigns to rank ``rn``.

    Rank r falls in bucket k when e(k-1) < r <= e(k) with edges
    e(k) = 1 + (n - 1) k / q, i.e. k = ceil(q (r - 1) / (n - 1)), at least 1.
    """
    return F.expr(f"cast(greatest(1, (({rn} - 1) * {q} + {n} - 2) div ({n} - 1)) as int)")


def window_row_number(df: DataFrame, order_cols: list, out_col: str = "rn") -> DataFrame:
    """Single-partition reference implementation (tests only)."""
    return df.withColumn(out_col, F.row_number().over(Window.orderBy(*order_cols)).cast("bigint"))
