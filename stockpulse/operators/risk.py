"""Inventory risk scoring.

One ``groupBy("sku_id")`` over the forecast rows (at most ``horizon`` rows
per SKU, so the collected forecast array is bounded by the horizon) and
column arithmetic; the original loops over SKUs in Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpulse.functions.columns import clip, clip01, round_half_up, with_defaults
from stockpulse.params import Params

# Actions, reasons and scoring constants.
ACTION_REORDER = "Reorder now"
ACTION_MARKDOWN = "Markdown / clear"
ACTION_WATCH = "Watch / volatile"
ACTION_HEALTHY = "Healthy"
REASON_REORDER = "Forecasted lead-time demand can exceed available stock."
REASON_MARKDOWN = "On-hand stock is materially higher than expected horizon demand."
REASON_WATCH = "SKU shows both shortage and excess signals; review manually."
REASON_HEALTHY = "Inventory appears aligned with the forecast."
SAFETY_LEAD_SHARE = 0.35
EXCESS_COVER = 1.45
PRIORITY_WEIGHTS = (0.48, 0.32, 0.20)

# The risk table, and what its first forecast row gives.
RISK_COLUMNS = [
    "sku_id", "sku_name", "category", "subcategory", "forecast_8w_units", "forecast_leadtime_units",
    "available_units", "on_hand_units", "on_order_units", "lead_time_days", "reorder_point", "stockout_risk",
    "overstock_risk", "volatility_risk", "recommended_action", "reason", "recommended_order_qty",
    "markdown_candidate_units", "sales_at_risk_rupees", "locked_capital_rupees", "priority_score",
]
FIRST_ROW = ["sku_name", "category", "subcategory", "on_hand_units", "on_order_units", "lead_time_days",
             "reorder_point", "damaged_units", "reserved_units", "list_price", "unit_cost"]

# Columns a forecast may lack: no damaged or reserved units, and the id serves as the name.
FIRST_ROW_DEFAULTS = {"damaged_units": 0.0, "reserved_units": 0.0, "sku_name": None}


def score_risk(forecasts: DataFrame, params: Params = Params(), sort: bool = True) -> DataFrame:
    forecasts = with_defaults(forecasts, FIRST_ROW_DEFAULTS)
    g = forecasts.groupBy(F.col("sku_id").alias("_sku")).agg(
        F.min("horizon_week").alias("min_h"), F.max("horizon_week").alias("max_h"),
        F.sort_array(F.collect_list(F.struct("horizon_week", "forecast_units"))).alias("fc"),
        F.sum("forecast_units").alias("demand_horizon"),                                          # K4
        F.stddev_samp("forecast_units").alias("fc_std"),
        F.avg("forecast_units").alias("fc_mean"),
    )
    # K1: the row of the first horizon week, joined back on the winner
    first = forecasts.select("sku_id", "horizon_week", F.struct(*FIRST_ROW).alias("f"))
    g = first.join(g, (F.col("sku_id") == F.col("_sku")) & (F.col("horizon_week") == F.col("min_h")))
    f = lambda c: F.col("f")[c]
    lead_weeks = F.greatest(F.lit(1), F.least(F.ceil(f("lead_time_days") / 7.0), F.col("max_h"))).cast("int")  # K2
    demand_lead = F.aggregate(F.slice("fc", 1, lead_weeks), F.lit(0.0),
                              lambda s, x: s + x["forecast_units"])                               # K3
    df = g.select("sku_id", "f", "demand_horizon", "fc_std", "fc_mean", demand_lead.alias("demand_lead"))
    available = clip(f("on_hand_units") + f("on_order_units") - f("damaged_units") - f("reserved_units"), 0.0)  # K5
    df = df.withColumn("available", available)
    safety = params.safety_stock_multiplier * F.greatest(f("reorder_point"), F.col("demand_lead") * SAFETY_LEAD_SHARE)
    df = df.withColumn("safety", safety)                                                         # K6
    df = df.withColumn("gap", F.col("demand_lead") + F.col("safety") - F.col("available"))
    df = df.withColumns({
        "stockout": clip01(F.col("gap") / (F.col("demand_lead") + F.col("safety") + 1)),           # K7
        "excess": clip(f("on_hand_units") - F.col("demand_horizon") * EXCESS_COVER, 0.0),          # K8
    })
    df = df.withColumns({
        "overstock": clip01(F.col("excess") / (f("on_hand_units") + 1)),
        "volatility": clip01(F.col("fc_std") / (F.col("fc_mean") + 1)),                            # K9
    })
    s, o = F.col("stockout"), F.col("overstock")
    st, ot = params.stockout_threshold, params.overstock_threshold
    action = (F.when((s >= st) & (o < ot), ACTION_REORDER)                                          # K10
               .when((o >= ot) & (s < st), ACTION_MARKDOWN)
               .when((s >= st) & (o >= ot), ACTION_WATCH)
               .otherwise(ACTION_HEALTHY))
    reason = (F.when((s >= st) & (o < ot), REASON_REORDER)
               .when((o >= ot) & (s < st), REASON_MARKDOWN)
               .when((s >= st) & (o >= ot), REASON_WATCH)
               .otherwise(REASON_HEALTHY))
    w1, w2, w3 = PRIORITY_WEIGHTS
    positive_gap = clip(F.col("gap"), 0.0)
    out = df.select(
        "sku_id",
        F.coalesce(f("sku_name").cast("string"), F.col("sku_id")).alias("sku_name"),
        f("category").alias("category"),
        f("subcategory").alias("subcategory"),
        round_half_up("demand_horizon", 2).alias("forecast_8w_units"),                             # K13
        round_half_up("demand_lead", 2).alias("forecast_leadtime_units"),
        round_half_up("available", 2).alias("available_units"),
        f("on_hand_units").alias("on_hand_units"),
        f("on_order_units").alias("on_order_units"),
        f("lead_time_days").alias("lead_time_days"),
        f("reorder_point").alias("reorder_point"),
        round_half_up("stockout", 4).alias("stockout_risk"),
        round_half_up("overstock", 4).alias("overstock_risk"),
        round_half_up("volatility", 4).alias("volatility_risk"),
        action.alias("recommended_action"),
        reason.alias("reason"),
        F.ceil(positive_gap).cast("int").alias("recommended_order_qty"),                          # K11
        F.ceil(F.col("excess")).cast("int").alias("markdown_candidate_units"),
        round_half_up(positive_gap * f("list_price"), 2).alias("sales_at_risk_rupees"),
        round_half_up(F.col("excess") * f("unit_cost"), 2).alias("locked_capital_rupees"),
        round_half_up(100 * (w1 * s + w2 * o + w3 * F.col("volatility")), 2).alias("priority_score"),  # K12
    )
    return out.orderBy(F.desc("priority_score"), "sku_id") if sort else out                        # K14


def rupees(column: str):
    """A money total by whole paise, which does not depend on the order of the rows."""
    return F.coalesce(F.sum(F.round(F.col(column) * 100).cast("bigint")) / 100, F.lit(0.0))


def risk_summary(risk: DataFrame) -> DataFrame:
    """One-row totals and action counts."""
    a = F.col("recommended_action")
    return risk.agg(
        rupees("sales_at_risk_rupees").alias("total_sales_at_risk_rupees"),
        rupees("locked_capital_rupees").alias("total_locked_capital_rupees"),
        F.count_if(a == ACTION_REORDER).alias("reorder_now_skus"),
        F.count_if(a == ACTION_MARKDOWN).alias("markdown_clear_skus"),
        F.count_if(a == ACTION_WATCH).alias("watch_volatile_skus"),
        F.count_if(a == ACTION_HEALTHY).alias("healthy_skus"),
    )
