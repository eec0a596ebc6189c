"""Distinct counts kept as mergeable sketches.

One aggregate over the sale lines leaves a HyperLogLog sketch of customers and
of orders for every SKU, region and week.  Any roll-up (by SKU, month, region,
over all) merges sketches and never reads the lines again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpulse.functions.columns import week_floor

LG_K = 13
#: Three standard errors of a merged sketch with 2^LG_K registers: nearly all estimates lie within.
ERROR = 3 * 1.04 / 2 ** (LG_K / 2)
COUNTED = {"customers": "customer_id", "orders": "order_id"}


def weekly_sketches(sales: DataFrame) -> DataFrame:
    """A row a SKU, region and week, with a sketch for each counted column (null ids are not counted)."""
    return sales.groupBy("sku_id", "region", week_floor("date").alias("week_start")).agg(
        *[F.hll_sketch_agg(F.col(c).cast("string"), LG_K).alias(f"{n}_sketch") for n, c in COUNTED.items()])


def roll_up(sketches: DataFrame, *by) -> DataFrame:
    """Estimated distinct counts by any columns of the sketch table (none: over all)."""
    merged = sketches.groupBy(*by).agg(*[F.hll_union_agg(f"{n}_sketch").alias(n) for n in COUNTED])
    kept = [c for c in merged.columns if c not in COUNTED]
    return merged.select(*kept, *[F.hll_sketch_estimate(n).alias(n) for n in COUNTED])
