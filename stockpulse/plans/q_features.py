"""Queries over the cleaning stage and the weekly feature table (C, W, P3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockpulse.operators import clean, features
from stockpulse.plans.catalogue import register

INV = ["on_hand_units", "on_order_units", "lead_time_days", "reorder_point", "damaged_units", "reserved_units"]
LAG_COLS = [f"lag_{k}" for k in (1, 2, 4, 8, 13, 26, 52)]
ROLL = ["rolling_4_mean", "rolling_8_mean", "rolling_13_std"]


@register("category_summary", covers="P3, W1-W26", r2=["revenue"], r4=["avg_inventory_cover"], sql="""
SELECT category, SUM(revenue) AS revenue, SUM(units_sold) AS units_sold, COUNT(DISTINCT sku_id) AS sku_count,
       AVG(inventory_cover_weeks) AS avg_inventory_cover
FROM weekly GROUP BY category ORDER BY revenue DESC, category LIMIT 8""")
def category_summary(ctx):
    """Revenue, units, SKU count and mean inventory cover by category (top 8)."""
    return (ctx.weekly.groupBy("category")
            .agg(F.sum("revenue").alias("revenue"), F.sum("units_sold").alias("units_sold"),
                 F.countDistinct("sku_id").alias("sku_count"),
                 F.avg("inventory_cover_weeks").alias("avg_inventory_cover"))
            .orderBy(F.desc("revenue"), "category").limit(8))


@register("clean_sales", covers="S1-S3, C1-C3, C5-C6, C8, C12", r4=["unit_price"], r2=["revenue"],
          sql="SELECT * FROM sales1_dirty")
def clean_sales(ctx):
    """Cleaned sales over the dirtied adapter: bad dates, duplicates, negatives, zero prices."""
    return clean.clean_sales(ctx.dirty_sales)


@register("dedup_keep_last", covers="C4, C9-C10", sql="SELECT * FROM sku1_dirty")
def dedup_keep_last(ctx):
    """SKU master with later broken rows: keep-last by file order, then median imputation."""
    return clean.clean_sku(ctx.dirty_sku)


@register("clean_inventory", covers="C4, C6-C7, C11, C13", sql="SELECT * FROM inv1_dirty")
def clean_inventory(ctx):
    """Snapshots with later broken duplicates: keep-last, coercion, clips, lead-time floor."""
    return clean.clean_inventory(ctx.dirty_inventory)


@register("calendar_derived", covers="C1-C2, C4, C14-C15", sql="SELECT * FROM cal1")
def calendar_derived(ctx):
    """Calendar with derived campaign intensity and weekend flag."""
    return ctx.cleaned["calendar"]


@register("weekly_sales", covers="W1-W2", r2=["revenue"], r4=["avg_unit_price", "avg_discount"],
          sql="SELECT * FROM ws")
def weekly_sales(ctx):
    """Sales hash aggregate by (sku, Monday week)."""
    return ctx.weekly_sales


@register("weekly_calendar", covers="W1, W3", r4=["campaign_intensity"], sql="SELECT * FROM wc")
def weekly_calendar(ctx):
    """Calendar aggregate by week."""
    return features.weekly_calendar(ctx.cleaned["calendar"])


@register("latest_snapshot", covers="W4", sql="SELECT * FROM wi")
def latest_snapshot(ctx):
    """Latest inventory snapshot per (sku, week)."""
    return features.latest_snapshot(ctx.cleaned["inventory_snapshots"])


@register("dense_spine", covers="W5-W8", r2=["revenue"], r4=["avg_unit_price", "avg_discount"], sql="""
SELECT sku_id, week_start, units_sold, revenue, avg_unit_price, promo_days, avg_discount, ad_spend, page_views,
       return_units, stockout_days, unique_customers
FROM wj""")
def dense_spine(ctx):
    """Every master SKU x every sales week, sales left-joined and zero-filled."""
    ws = ctx.weekly_sales
    df = features.reindexed(features.dense_spine(ctx.cleaned["sku_master"], ws), ws)
    return df.select("sku_id", "week_start", "units_sold", "revenue", "avg_unit_price", "promo_days",
                     "avg_discount", "ad_spend", "page_views", "return_units", "stockout_days",
                     "unique_customers")


@register("joined_week", covers="W9-W12, W16-W17, W25-W26", r4=["avg_unit_price", "gross_margin",
                                                                 "campaign_intensity"], sql="""
SELECT sku_id, week_start, category, subcategory, unit_cost, list_price, avg_unit_price, gross_margin, month, week,
       campaign_intensity, holiday_days, weekend_days
FROM weekly""")
def joined_week(ctx):
    """SKU attributes, calendar measures, price fill and gross margin per sku-week."""
    return ctx.weekly.select("sku_id", "week_start", "category", "subcategory", "unit_cost", "list_price",
                             "avg_unit_price", "gross_margin", "month", "week", "campaign_intensity",
                             "holiday_days", "weekend_days")


@register("inventory_fill", covers="W13-W15", sql=f"""
SELECT sku_id, week_start, {', '.join(INV)}, warehouse_zone FROM weekly""")
def inventory_fill(ctx):
    """Forward then backward fill of snapshot columns per SKU."""
    return ctx.weekly.select("sku_id", "week_start", *INV, "warehouse_zone")


@register("demand_lags", covers="W18", sql=f"SELECT sku_id, week_start, units_sold, {', '.join(LAG_COLS)} FROM wl")
def demand_lags(ctx):
    """Lags 1-52 of weekly units, before imputation."""
    return ctx.pre_fill.select("sku_id", "week_start", "units_sold", *LAG_COLS)


@register("rolling_stats", covers="W19-W20", r4=ROLL, sql=f"SELECT sku_id, week_start, {', '.join(ROLL)} FROM wl")
def rolling_stats(ctx):
    """Guarded rolling mean (4, 8) and sample std (13) of previous weeks."""
    return ctx.pre_fill.select("sku_id", "week_start", *ROLL)


@register("sell_through_cover", covers="W21-W22", r4=["sell_through_proxy", "inventory_cover_weeks"], sql="""
SELECT sku_id, week_start, sell_through_proxy, inventory_cover_weeks FROM weekly""")
def sell_through_cover(ctx):
    """Sell-through proxy and inventory cover weeks."""
    return ctx.weekly.select("sku_id", "week_start", "sell_through_proxy", "inventory_cover_weeks")


@register("median_imputed", covers="W23-W24", r4=LAG_COLS + ROLL, sql=f"""
SELECT sku_id, week_start, {', '.join(LAG_COLS + ROLL)} FROM weekly""")
def median_imputed(ctx):
    """Lags and rolling statistics after per-SKU then global median fills."""
    return ctx.weekly.select("sku_id", "week_start", *LAG_COLS, *ROLL)


WEEKLY_DOUBLES = (["avg_unit_price", "avg_discount", "gross_margin", "campaign_intensity", "sell_through_proxy",
                   "inventory_cover_weeks"] + LAG_COLS + ROLL)


@register("weekly_features", covers="W1-W26", r2=["revenue"], r4=WEEKLY_DOUBLES, sql="SELECT * FROM weekly")
def weekly_features(ctx):
    """The complete dense weekly feature table."""
    return ctx.weekly
