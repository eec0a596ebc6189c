"""Cleaning of the four extracts.

Keyed "keep the last row" deduplication maximises the ingest ordinal by key in
a hash aggregate (combined before the shuffle) and joins the winners back; AQE
splits a key that holds a large share of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpulse.functions.columns import clip, coerce_bool, coerce_date, coerce_double, with_defaults
from stockpulse.functions.dedup import distinct_rows
from stockpulse.functions.ranking import keep_best
from stockpulse.functions.selection import exact_medians
from stockpulse.sources.io import ORD

# Defaults for optional columns.
SALES_DEFAULTS = {
    "customer_id": "UNKNOWN_CUSTOMER",
    "sales_channel": "Unknown",
    "region": "Unknown",
    "discount_pct": 0.0,
    "ad_spend": 0.0,
    "page_views": 0,
    "return_units": 0,
    "stockout_flag": False,
}
INVENTORY_DEFAULTS = {"warehouse_zone": "Unknown", "damaged_units": 0, "reserved_units": 0}
# The columns that are coerced to numbers.
NUMERIC_SALES = ["units_sold", "revenue", "unit_price", "discount_pct", "ad_spend", "page_views", "return_units"]
NUMERIC_SKU = ["unit_cost", "list_price", "target_margin"]
NUMERIC_INVENTORY = ["on_hand_units", "on_order_units", "lead_time_days", "reorder_point",
                     "damaged_units", "reserved_units"]


def need_order(df: DataFrame) -> DataFrame:
    """Keep-last has no meaning without the file order."""
    if ORD not in df.columns:
        raise ValueError(f"the column {ORD!r} (file order) is needed; read the extract with sources.io.read_extract")
    return df


def keep_last(df: DataFrame, keys: list[str], order_col: str = ORD) -> DataFrame:
    """C4: one row per key, the one latest in ``order_col`` (file order, a number that is different in every row)."""
    return keep_best(df, keys, order_col)


def clean_sales(sales: DataFrame, by_digest: bool = False) -> DataFrame:
    """The cleaned sales.

    ``by_digest`` suits extracts read from files: duplicates are found by
    digests, and unique rows are not shuffled.  Rows out of a join already lie
    together by order, which the plain removal uses.
    """
    df = sales.drop(ORD) if ORD in sales.columns else sales
    df = df.withColumn("date", coerce_date(df, "date"))                       # C1
    df = df.dropna(subset=["date", "sku_id"])                                  # C2
    df = distinct_rows(df) if by_digest else df.dropDuplicates()               # C3 (raw values)
    present = [c for c in NUMERIC_SALES if c in df.columns]
    df = df.withColumns({c: F.coalesce(coerce_double(df, c), F.lit(0.0)) for c in present})  # C5
    df = df.withColumns({
        "units_sold": clip("units_sold", 0.0),                                 # C6
        "revenue": clip("revenue", 0.0),
        "unit_price": F.nullif(F.col("unit_price"), F.lit(0.0)),               # C8
    })
    df = with_defaults(df, SALES_DEFAULTS)                                     # C12
    df = df.withColumn("promo_flag", coerce_bool(df, "promo_flag"))
    df = df.withColumn("stockout_flag", coerce_bool(df, "stockout_flag"))
    return df.withColumns({c: coerce_double(df, c) for c in ("ad_spend", "page_views", "return_units",
                                                             "discount_pct")})


def clean_sku(sku: DataFrame) -> DataFrame:
    df = need_order(sku)
    df = df.withColumn("launch_date", coerce_date(df, "launch_date"))          # C1
    df = df.dropna(subset=["sku_id", "category"])                              # C2
    df = keep_last(df, ["sku_id"])                                             # C4
    present = [c for c in NUMERIC_SKU if c in df.columns]
    df = df.withColumns({c: coerce_double(df, c) for c in present})            # C9
    # Both global medians from the same passes
    medians = exact_medians(df, ["unit_cost", "list_price"])
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit(m).cast("double")) for c, m in medians.items()})
    return df.drop(ORD)


def clean_calendar(cal: DataFrame) -> DataFrame:
    df = need_order(cal)
    df = df.withColumn("date", coerce_date(df, "date"))                        # C1
    df = df.dropna(subset=["date"])                                            # C2
    df = keep_last(df, ["date"])                                               # C4
    if "campaign_intensity" not in df.columns:                                 # C14
        df = df.withColumn("campaign_intensity",
                           F.when(F.coalesce(F.col("promo_event"), F.lit("None")) != "None", F.lit(2))
                            .otherwise(F.lit(0)))
    if "is_weekend" not in df.columns:                                         # C15
        df = df.withColumn("is_weekend", F.weekday("date") >= 5)
    df = df.withColumn("is_holiday", coerce_bool(df, "is_holiday"))
    return df.drop(ORD)


def clean_inventory(inv: DataFrame) -> DataFrame:
    df = need_order(inv)
    df = df.withColumn("date", coerce_date(df, "date"))                        # C1
    df = df.dropna(subset=["date", "sku_id"])                                  # C2
    df = keep_last(df, ["date", "sku_id"])                                     # C4
    present = [c for c in NUMERIC_INVENTORY if c in df.columns]
    df = df.withColumns({c: F.coalesce(coerce_double(df, c), F.lit(0.0)) for c in present})  # C11
    df = df.withColumns({c: clip(c, 0.0) for c in present if c != "lead_time_days"})        # C6
    df = df.withColumn("lead_time_days", clip("lead_time_days", 1.0))          # C7
    df = with_defaults(df, INVENTORY_DEFAULTS)                                 # C13
    df = df.withColumns({c: coerce_double(df, c) for c in ("damaged_units", "reserved_units")})
    return df.drop(ORD)
