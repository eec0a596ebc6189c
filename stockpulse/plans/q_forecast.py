"""Forecast and inventory-risk queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockpulse.operators import forecast as fc
from stockpulse.operators import risk as rk
from stockpulse.plans.catalogue import register
from stockpulse.session import materialize

H = 8
_NUM_PRESENT = [c for c in fc.NUMERIC_FEATURES if c != "target_margin"]
_ROLL_STATE = ["lag_1", "lag_2", "lag_4", "lag_8", "lag_13", "lag_26", "lag_52", "rolling_4_mean",
               "rolling_8_mean", "rolling_13_std"]
_FUT_OVERRIDE = ["week_start", "month", "week", "promo_days", "campaign_intensity", "holiday_days",
                 "units_sold"] + _ROLL_STATE


def _r(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38, 9)), {n}) AS DOUBLE)"


def _tail_mean(k: int) -> str:
    return f"list_avg(_a[-{k}:])"


_BASE = "COALESCE(lag_52, lag_4, rolling_4_mean, 0)"
_STD = "(SELECT COALESCE(STDDEV_SAMP(residual), 1.0) FROM bt)"
_WAPE = ("CASE WHEN SUM(ABS(units_sold)) = 0 THEN AVG(ABS(units_sold - {f})) "
         "ELSE SUM(ABS(units_sold - {f})) / SUM(ABS(units_sold)) END")
_BIAS = "CASE WHEN SUM(ABS(units_sold)) = 0 THEN 0.0 ELSE SUM({f} - units_sold) / SUM(ABS(units_sold)) END"

CTES = [
    ("prep", "\n  SELECT * REPLACE (" + ",\n    ".join(
        [f"COALESCE(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in _NUM_PRESENT]
        + [f"COALESCE(CAST({c} AS VARCHAR), 'Unknown') AS {c}" for c in ("category", "subcategory", "brand",
                                                                        "warehouse_zone")]
        + ["GREATEST(COALESCE(units_sold, 0.0), 0.0) AS units_sold"])
     + "),\n    0.0 AS target_margin, 'Unknown' AS lifecycle_stage\n  FROM weekly"),
    ("split", f"""
  SELECT *, week_start >= (SELECT MAX(week_start) FROM prep) - {7 * (H - 1)} AS is_test FROM prep"""),
    ("bt", f"""
  SELECT sku_id, week_start, category, subcategory, units_sold, {_BASE} AS model_forecast,
         {_BASE} AS seasonal_naive_forecast, units_sold - {_BASE} AS residual,
         ABS(units_sold - {_BASE}) AS abs_error_model, ABS(units_sold - {_BASE}) AS abs_error_baseline
  FROM split WHERE is_test"""),
    ("hist", """
  SELECT sku_id, list(units_sold ORDER BY week_start) AS h
  FROM (SELECT sku_id, week_start, units_sold,
               row_number() OVER (PARTITION BY sku_id ORDER BY week_start DESC) AS _r FROM prep)
  WHERE _r <= 52 GROUP BY sku_id"""),
    ("roll", f"""
  SELECT sku_id, 1 AS step, h AS a FROM hist
  UNION ALL
  SELECT sku_id, step + 1, list_append(a, list_avg(a[-4:])) FROM roll WHERE step < {H}"""),
    ("lastrow", """
  SELECT * EXCLUDE (_r) FROM (SELECT *, row_number() OVER (PARTITION BY sku_id ORDER BY week_start DESC) AS _r
                              FROM prep) WHERE _r = 1"""),
    ("fut0", f"""
  SELECT l.* EXCLUDE ({', '.join(_FUT_OVERRIDE)}), r.step AS horizon_week, r.a AS _a,
         (SELECT MAX(week_start) FROM prep) + CAST(7 * r.step AS INTEGER) AS week_start
  FROM roll r JOIN lastrow l ON l.sku_id = r.sku_id"""),
    ("fut1", f"""
  SELECT * EXCLUDE (_a),
         CAST(month(week_start) AS DOUBLE) AS month, CAST(weekofyear(week_start) AS DOUBLE) AS week,
         CASE WHEN month(week_start) IN (10, 11, 12) THEN 1.0 ELSE 0.0 END AS promo_days,
         CASE WHEN month(week_start) IN (10, 11) THEN 3.0 WHEN month(week_start) IN (6, 7, 12) THEN 1.0 ELSE 0.0 END
           AS campaign_intensity,
         CASE WHEN month(week_start) IN (8, 10, 12, 1) AND horizon_week % 3 = 0 THEN 1.0 ELSE 0.0 END AS holiday_days,
         CASE WHEN len(_a) >= 1 THEN _a[-1] ELSE 0.0 END AS lag_1,
         CASE WHEN len(_a) >= 2 THEN _a[-2] WHEN len(_a) >= 1 THEN _a[-1] ELSE 0.0 END AS lag_2,
         CASE WHEN len(_a) >= 4 THEN _a[-4] ELSE {_tail_mean(4)} END AS lag_4,
         CASE WHEN len(_a) >= 8 THEN _a[-8] ELSE {_tail_mean(8)} END AS lag_8,
         CASE WHEN len(_a) >= 13 THEN _a[-13] ELSE {_tail_mean(13)} END AS lag_13,
         CASE WHEN len(_a) >= 26 THEN _a[-26] ELSE {_tail_mean(26)} END AS lag_26,
         CASE WHEN len(_a) >= 52 THEN _a[-52] WHEN len(_a) >= 4 THEN _a[-4] ELSE {_tail_mean(4)} END AS lag_52,
         {_tail_mean(4)} AS rolling_4_mean,
         {_tail_mean(8)} AS rolling_8_mean,
         CASE WHEN len(_a) >= 2 THEN sqrt(list_var_pop(_a[-13:])) ELSE 0.0 END AS rolling_13_std,
         0.0 AS units_sold
  FROM fut0"""),
    ("fcb", f"""
  SELECT sku_id, sku_name, category, subcategory, week_start, CAST(horizon_week AS INTEGER) AS horizon_week,
         {_BASE} AS forecast_units,
         GREATEST({_BASE} - 1.28 * {_STD}, 0) AS forecast_lower_80,
         {_BASE} + 1.28 * {_STD} AS forecast_upper_80,
         {_BASE} AS baseline_forecast, avg_unit_price, unit_cost, list_price, on_hand_units, on_order_units,
         lead_time_days, reorder_point, damaged_units, reserved_units, lifecycle_stage
  FROM fut1"""),
    ("rk0", """
  SELECT sku_id, arg_min(sku_name, horizon_week) AS sku_name, arg_min(category, horizon_week) AS category,
         arg_min(subcategory, horizon_week) AS subcategory, arg_min(on_hand_units, horizon_week) AS on_hand_units,
         arg_min(on_order_units, horizon_week) AS on_order_units,
         arg_min(lead_time_days, horizon_week) AS lead_time_days,
         arg_min(reorder_point, horizon_week) AS reorder_point, arg_min(damaged_units, horizon_week) AS damaged_units,
         arg_min(reserved_units, horizon_week) AS reserved_units, arg_min(list_price, horizon_week) AS list_price,
         arg_min(unit_cost, horizon_week) AS unit_cost, MAX(horizon_week) AS max_h,
         SUM(forecast_units) AS demand_horizon, STDDEV_SAMP(forecast_units) AS fc_std,
         AVG(forecast_units) AS fc_mean, list(forecast_units ORDER BY horizon_week) AS fc
  FROM fcb GROUP BY sku_id"""),
    ("rk1", """
  SELECT *, list_sum(fc[1:GREATEST(1, LEAST(CAST(CEIL(lead_time_days / 7.0) AS INTEGER), max_h))]) AS demand_lead,
         GREATEST(on_hand_units + on_order_units - damaged_units - reserved_units, 0) AS available
  FROM rk0"""),
    ("rk2", "\n  SELECT *, 1.15 * GREATEST(reorder_point, demand_lead * 0.35) AS safety FROM rk1"),
    ("rk3", """
  SELECT *, demand_lead + safety - available AS gap, GREATEST(on_hand_units - demand_horizon * 1.45, 0) AS excess
  FROM rk2"""),
    ("rk4", """
  SELECT *, LEAST(GREATEST(gap / (demand_lead + safety + 1), 0), 1) AS s,
         LEAST(GREATEST(excess / (on_hand_units + 1), 0), 1) AS o,
         LEAST(GREATEST(fc_std / (fc_mean + 1), 0), 1) AS v
  FROM rk3"""),
    ("risk", f"""
  SELECT sku_id, COALESCE(sku_name, sku_id) AS sku_name, category, subcategory,
         {_r('demand_horizon', 2)} AS forecast_8w_units, {_r('demand_lead', 2)} AS forecast_leadtime_units,
         {_r('available', 2)} AS available_units, on_hand_units, on_order_units, lead_time_days, reorder_point,
         {_r('s', 4)} AS stockout_risk, {_r('o', 4)} AS overstock_risk, {_r('v', 4)} AS volatility_risk,
         CASE WHEN s >= 0.55 AND o < 0.55 THEN '{rk.ACTION_REORDER}'
              WHEN o >= 0.55 AND s < 0.55 THEN '{rk.ACTION_MARKDOWN}'
              WHEN s >= 0.55 AND o >= 0.55 THEN '{rk.ACTION_WATCH}'
              ELSE '{rk.ACTION_HEALTHY}' END AS recommended_action,
         CASE WHEN s >= 0.55 AND o < 0.55 THEN '{rk.REASON_REORDER}'
              WHEN o >= 0.55 AND s < 0.55 THEN '{rk.REASON_MARKDOWN}'
              WHEN s >= 0.55 AND o >= 0.55 THEN '{rk.REASON_WATCH}'
              ELSE '{rk.REASON_HEALTHY}' END AS reason,
         CAST(CEIL(GREATEST(gap, 0)) AS INTEGER) AS recommended_order_qty,
         CAST(CEIL(excess) AS INTEGER) AS markdown_candidate_units,
         {_r('GREATEST(gap, 0) * list_price', 2)} AS sales_at_risk_rupees,
         {_r('excess * unit_cost', 2)} AS locked_capital_rupees,
         {_r('100 * (0.48 * s + 0.32 * o + 0.2 * v)', 2)} AS priority_score
  FROM rk4"""),
]


def _baseline(ctx):
    """Baseline run; its small outputs are checkpointed once per context."""
    key = "_baseline_run"
    if key not in ctx.__dict__:
        run = fc.baseline_run(ctx.weekly, ctx.params)
        for name in ("backtest", "metrics", "forecasts"):
            run[name] = materialize(run[name], f"baseline-{name}")
        ctx.__dict__[key] = run
    return ctx.__dict__[key]


def _risk(ctx):
    key = "_risk_table"
    if key not in ctx.__dict__:
        ctx.__dict__[key] = materialize(rk.score_risk(_baseline(ctx)["forecasts"], ctx.params, sort=False), "risk")
    return ctx.__dict__[key]


@register("holdout_split", covers="F1-F3", sql="""
SELECT sku_id, week_start, CASE WHEN is_test THEN 'test' ELSE 'train' END AS split, units_sold, target_margin,
       lifecycle_stage FROM split""")
def holdout_split(ctx):
    """Feature preparation and the time holdout (last 8 weeks = test)."""
    prepared = fc.prepare(ctx.weekly)
    start = fc.test_start(prepared, ctx.params.horizon_weeks)
    return prepared.select("sku_id", "week_start",
                           F.when(F.col("week_start") >= start, "test").otherwise("train").alias("split"),
                           "units_sold", "target_margin", "lifecycle_stage")


@register("baseline_metrics", covers="F8-F15", r4=["model_wape", "baseline_wape", "model_bias", "baseline_bias",
                                                    "mae"], sql=f"""
SELECT CASE WHEN GROUPING(category) = 1 THEN 'overall' ELSE category END AS scope, 'seasonal_naive' AS model,
       {_WAPE.format(f='model_forecast')} AS model_wape, {_WAPE.format(f='seasonal_naive_forecast')} AS baseline_wape,
       {_BIAS.format(f='model_forecast')} AS model_bias,
       CASE WHEN GROUPING(category) = 1 THEN {_BIAS.format(f='seasonal_naive_forecast')} END AS baseline_bias,
       CASE WHEN GROUPING(category) = 1 THEN AVG(ABS(units_sold - model_forecast)) END AS mae,
       CAST({H} AS INTEGER) AS test_weeks, (SELECT COUNT(*) FROM split WHERE NOT is_test) AS train_rows,
       COUNT(*) AS test_rows
FROM bt GROUP BY ROLLUP (category)""")
def baseline_metrics(ctx):
    """WAPE, bias and MAE of the seasonal-naive forecast, overall and per category."""
    return _baseline(ctx)["metrics"]


@register("backtest_baseline", covers="F3, F8-F9", r4=["model_forecast", "seasonal_naive_forecast", "residual",
                                                        "abs_error_model", "abs_error_baseline"],
          sql="SELECT * FROM bt")
def backtest_baseline(ctx):
    """Per-row backtest predictions and errors of the baseline."""
    return _baseline(ctx)["backtest"]


@register("future_frame", covers="F17-F20, F23", r4=_ROLL_STATE, sql=f"""
SELECT sku_id, week_start, CAST(horizon_week AS INTEGER) AS horizon_week, month, week, promo_days,
       campaign_intensity, holiday_days, {', '.join(_ROLL_STATE)} FROM fut1""")
def future_frame(ctx):
    """Horizon rows per SKU with recursively rolled-out lags and rolling statistics."""
    f = fc.future_frame(fc.prepare(ctx.weekly), ctx.params.horizon_weeks)
    return f.select("sku_id", "week_start", F.col("horizon_week").cast("int").alias("horizon_week"), "month",
                    "week", "promo_days", "campaign_intensity", "holiday_days", *_ROLL_STATE)


@register("baseline_forecast", covers="F8, F22-F24",
          r4=["forecast_units", "forecast_lower_80", "forecast_upper_80", "baseline_forecast", "avg_unit_price"],
          sql="SELECT * FROM fcb")
def baseline_forecast(ctx):
    """8-week SKU forecast table with the baseline as forecast and an 80 % band."""
    return _baseline(ctx)["forecasts"]


@register("risk_scores", covers="K1-K14", sql="SELECT * FROM risk ORDER BY priority_score DESC, sku_id")
def risk_scores(ctx):
    """Stockout / overstock / volatility risk, action and money impact per SKU."""
    return _risk(ctx).orderBy(F.desc("priority_score"), "sku_id")


@register("risk_summary", covers="K15, P1", r2=["total_sales_at_risk_rupees", "total_locked_capital_rupees"], sql=f"""
SELECT COALESCE(SUM(sales_at_risk_rupees), 0.0) AS total_sales_at_risk_rupees,
       COALESCE(SUM(locked_capital_rupees), 0.0) AS total_locked_capital_rupees,
       COUNT(*) FILTER (WHERE recommended_action = '{rk.ACTION_REORDER}') AS reorder_now_skus,
       COUNT(*) FILTER (WHERE recommended_action = '{rk.ACTION_MARKDOWN}') AS markdown_clear_skus,
       COUNT(*) FILTER (WHERE recommended_action = '{rk.ACTION_WATCH}') AS watch_volatile_skus,
       COUNT(*) FILTER (WHERE recommended_action = '{rk.ACTION_HEALTHY}') AS healthy_skus
FROM risk""")
def risk_summary(ctx):
    """One-row impact totals and action counts."""
    return rk.risk_summary(_risk(ctx))


def _ridge(ctx):
    key = "_ridge_run"
    if key not in ctx.__dict__:
        ctx.__dict__[key] = fc.ridge_run(ctx.weekly, ctx.params)
    return ctx.__dict__[key]


@register("ridge_metrics", covers="F4-F7, F9-F16")
def ridge_metrics(ctx):
    """Backtest metrics of the ridge model next to the baseline (model fit: rows-only check)."""
    return _ridge(ctx)["metrics"]


@register("ridge_forecast", covers="F16, F20-F24")
def ridge_forecast(ctx):
    """8-week SKU forecast from the ridge model refitted on all weeks."""
    return _ridge(ctx)["forecasts"]


@register("ridge_risk_scores", covers="K1-K14 on the ridge forecast")
def ridge_risk_scores(ctx):
    """Risk table fed by the ridge forecast, as the batch run produces it."""
    return rk.score_risk(_ridge(ctx)["forecasts"], ctx.params)
