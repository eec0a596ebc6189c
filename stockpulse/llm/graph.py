"""Connected groups of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpulse.session import materialize, release


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(``node``, ``component``) of every node that has an edge to another; the component is its smallest node.

    Each round hangs every node's larger neighbours, then its smaller ones,
    under the smallest node around.  Rounds grow with the logarithm of the
    longest chain; the edge table never grows.  It is written after every
    round to the checkpoint folder, where the round before it is removed, and only its count and a checksum come to
    the driver.  Null ends and loops are ignored.
    """
    stars = materialize(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    last = None if stars.take(1) else (0, None)
    for _ in range(max_rounds):
        if last == (0, None):
            break
        both = stars.unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(low.select("u", F.col("m").alias("v"))).distinct())
        before, stars = stars, materialize(small, "edges")
        release(before)
        now = tuple(stars.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
