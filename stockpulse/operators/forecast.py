"""Demand forecast: holdout backtest, seasonal-naive baseline, ridge model,
recursive 8-week feature rollout (F1-F24).

* The recursive rollout (F20) is a closed recurrence (each step appends the
  mean of the last four values), so it runs as Spark higher-order functions
  over a per-SKU array holding at most the last 52 weekly values: no Python,
  no per-SKU loop, and the array size is fixed by the lag depth, not by the
  data volume.
* The ridge fits (``operators.ridge``) are solved from sufficient statistics
  of one pass over the weekly table.
* Predictions stay aligned with their own row (``transform``), which fixes
  the original's week-major/SKU-major misassignment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpulse.functions.columns import bias, clip, coerce_double, mae, nan_to_null, wape
from stockpulse.operators.ridge import RidgeModel, RidgeStatistics, sufficient_statistics
from stockpulse.params import LAGS, Params

# Model inputs.
NUMERIC_FEATURES = [
    "avg_unit_price", "promo_days", "avg_discount", "ad_spend", "page_views", "stockout_days",
    "campaign_intensity", "holiday_days", "weekend_days", "unit_cost", "list_price", "target_margin",
    "on_hand_units", "on_order_units", "lead_time_days", "reorder_point", "damaged_units", "reserved_units",
    "gross_margin", "lag_1", "lag_2", "lag_4", "lag_8", "lag_13", "lag_26", "lag_52",
    "rolling_4_mean", "rolling_8_mean", "rolling_13_std", "sell_through_proxy", "inventory_cover_weeks", "month", "week",
]
CATEGORICAL_FEATURES = ["category", "subcategory", "brand", "lifecycle_stage", "warehouse_zone"]
TARGET = "units_sold"
# Same-week quantities that are only known after the week closes.
LEAK_FREE_NUMERIC = [c for c in NUMERIC_FEATURES
                     if c not in ("sell_through_proxy", "page_views", "ad_spend", "stockout_days")]
INTERVAL_Z = 1.28
ROLLING_DEPTH = 13
# The forecast table.
FORECAST_COLUMNS = [
    "sku_id", "sku_name", "category", "subcategory", "week_start", "horizon_week", "forecast_units",
    "forecast_lower_80", "forecast_upper_80", "baseline_forecast", "avg_unit_price", "unit_cost", "list_price",
    "on_hand_units", "on_order_units", "lead_time_days", "reorder_point", "damaged_units", "reserved_units",
    "lifecycle_stage",
]


# ---------------------------------------------------------------- F1-F3, F8
def prepare(df: DataFrame) -> DataFrame:
    """F1-F2: add absent features, coerce, NaN/inf/null -> 0, categories -> text."""
    for c in NUMERIC_FEATURES:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(0.0))
    for c in CATEGORICAL_FEATURES:
        if c not in df.columns:
            df = df.withColumn(c, F.lit("Unknown"))
    cols = {c: F.coalesce(coerce_double(df, c), F.lit(0.0)) for c in NUMERIC_FEATURES}
    cols.update({c: F.coalesce(F.col(c).cast("string"), F.lit("Unknown")) for c in CATEGORICAL_FEATURES})
    cols[TARGET] = clip(F.coalesce(coerce_double(df, TARGET), F.lit(0.0)), 0.0)
    return df.withColumns(cols)


def check_lags(params: Params) -> Params:
    """The seasonal baseline reads a lag column, and falls back to lag 4."""
    missing = {params.seasonal_lag_weeks, 4} - set(params.lags)
    if missing:
        raise ValueError(f"lags must hold {sorted(missing)}: the baseline reads them")
    return params


def test_start(weekly: DataFrame, horizon: int) -> Column:
    last = weekly.select(F.max("week_start")).scalar()
    return F.date_sub(last, 7 * (horizon - 1))


def holdout_split(prepared: DataFrame, horizon: int) -> tuple[DataFrame, DataFrame]:
    """the last ``horizon`` weeks are the test set."""
    start = test_start(prepared, horizon)
    return prepared.where(F.col("week_start") < start), prepared.where(F.col("week_start") >= start)


def baseline_forecast(seasonal_lag: int = 52) -> Column:
    """F8: seasonal naive with fallbacks."""
    return F.coalesce(F.col(f"lag_{seasonal_lag}"), F.col("lag_4"), F.col("rolling_4_mean"), F.lit(0.0))


def backtest_frame(test: DataFrame, model_col: Column, seasonal_lag: int = 52) -> DataFrame:
    """per-row forecasts, residual and absolute errors."""
    df = test.select("sku_id", "week_start", "category", "subcategory", TARGET,
                     model_col.alias("model_forecast"), baseline_forecast(seasonal_lag).alias("seasonal_naive_forecast"))
    return df.withColumns({
        "residual": F.col(TARGET) - F.col("model_forecast"),
        "abs_error_model": F.abs(F.col(TARGET) - F.col("model_forecast")),
        "abs_error_baseline": F.abs(F.col(TARGET) - F.col("seasonal_naive_forecast")),
    })


def metrics(pred: DataFrame, train_rows: Column, horizon: int, model_name: str = "ridge_regression") -> DataFrame:
    """Overall row plus one row per category in one grouping-sets pass.

    Category rows carry no baseline bias and no MAE, and the global train
    row count, as the original does.
    """
    a, m, b = F.col(TARGET), F.col("model_forecast"), F.col("seasonal_naive_forecast")
    g = pred.rollup("category").agg(
        F.grouping_id().alias("_gid"),
        wape(a, m).alias("model_wape"), wape(a, b).alias("baseline_wape"),
        bias(a, m).alias("model_bias"), bias(a, b).alias("baseline_bias"),
        mae(a, m).alias("mae"), F.count(F.lit(1)).alias("test_rows"))
    overall = F.col("_gid") == 1
    return g.select(
        F.when(overall, F.lit("overall")).otherwise(F.col("category")).alias("scope"),
        F.lit(model_name).alias("model"),
        "model_wape", "baseline_wape", "model_bias",
        F.when(overall, F.col("baseline_bias")).alias("baseline_bias"),
        F.when(overall, F.col("mae")).alias("mae"),
        F.lit(horizon).alias("test_weeks"),
        train_rows.alias("train_rows"),
        "test_rows",
    )


# ---------------------------------------------------------------- F17-F20, F23
def _tail(arr: Column, k: int) -> Column:
    return F.slice(arr, F.greatest(F.size(arr) - (k - 1), F.lit(1)), k)


def _mean_tail(arr: Column, k: int) -> Column:
    t = _tail(arr, k)
    return F.aggregate(t, F.lit(0.0), lambda s, x: s + x) / F.size(t)


def _pop_std_tail(arr: Column, k: int) -> Column:
    t = _tail(arr, k)
    m = F.aggregate(t, F.lit(0.0), lambda s, x: s + x) / F.size(t)
    return F.sqrt(F.aggregate(t, F.lit(0.0), lambda s, x: s + (x - m) * (x - m)) / F.size(t))


def _lag_or_mean(a: Column, k: int) -> Column:
    return F.when(F.size(a) >= k, F.element_at(a, -k)).otherwise(_mean_tail(a, k))


def rollout_lags(a: Column, lags) -> dict[str, Column]:
    """Lag columns from the history array; fallbacks where the history is shorter.

    Lag 2 falls back to lag 1, seasonal lags (a year or longer) to lag 4, the
    others to the mean of what there is.
    """
    out = {}
    for k in lags:
        if k == 1:
            out["lag_1"] = F.when(F.size(a) >= 1, F.element_at(a, -1)).otherwise(F.lit(0.0))
        elif k == 2:
            out["lag_2"] = F.when(F.size(a) >= 2, F.element_at(a, -2)).when(F.size(a) >= 1, F.element_at(a, -1)).otherwise(F.lit(0.0))
        elif k >= 52:
            out[f"lag_{k}"] = F.when(F.size(a) >= k, F.element_at(a, -k)).otherwise(_lag_or_mean(a, 4))
        else:
            out[f"lag_{k}"] = _lag_or_mean(a, k)
    return out


def future_frame(prepared: DataFrame, horizon: int, lags=LAGS) -> DataFrame:
    """One row per SKU and horizon week with rolled-out lags.

    Each step appends the mean of the last four values (never a model
    prediction), so the recurrence is closed and needs only as many weekly
    values of each SKU as the longest lag reaches back.
    """
    depth = max(*lags, ROLLING_DEPTH)
    last_week = prepared.select(F.max("week_start")).scalar()
    recent = Window.partitionBy("sku_id").orderBy(F.desc("week_start"))
    ranked = prepared.withColumn("_r", F.row_number().over(recent))
    last = ranked.where(F.col("_r") == 1).select("sku_id", F.struct(*[c for c in prepared.columns if c != "sku_id"]).alias("_last"))   # F17
    history = (ranked.where(F.col("_r") <= depth).groupBy(F.col("sku_id").alias("_sku"))
                     .agg(F.sort_array(F.collect_list(F.struct("week_start", TARGET))).alias("_h")))
    per_sku = last.join(history, F.col("sku_id") == F.col("_sku"))   # both sides are partitioned by SKU already
    hist = F.transform("_h", lambda s: s[TARGET].cast("double"))
    # whole recurrence: hist ++ [m1, m2, ..., mH]
    rolled = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), hist,
                         lambda acc, i: F.concat(acc, F.array(_mean_tail(acc, 4))))
    df = per_sku.select("sku_id", "_last", F.size("_h").alias("_n"), rolled.alias("_all"),
                        F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon_week"))
    a = F.slice(F.col("_all"), 1, F.col("_n") + F.col("horizon_week") - 1)   # state before this step
    ws = F.date_add(last_week, F.col("horizon_week") * 7)
    base_cols = [F.col("_last")[c].alias(c) for c in prepared.columns if c != "sku_id"]
    df = df.select("sku_id", "horizon_week", a.alias("_a"), ws.alias("_ws"), *base_cols)
    a = F.col("_a")
    m = F.month("_ws")
    df = df.withColumns({
        "week_start": F.col("_ws"),
        "month": m,
        "week": F.weekofyear("_ws"),
        "promo_days": F.when(m.isin(10, 11, 12), 1.0).otherwise(0.0),
        "campaign_intensity": F.when(m.isin(10, 11), 3.0).when(m.isin(6, 7, 12), 1.0).otherwise(0.0),
        "holiday_days": F.when(m.isin(8, 10, 12, 1) & (F.col("horizon_week") % 3 == 0), 1.0).otherwise(0.0),
        **rollout_lags(a, lags),
        "rolling_4_mean": _mean_tail(a, 4),
        "rolling_8_mean": _mean_tail(a, 8),
        "rolling_13_std": F.when(F.size(a) >= 2, _pop_std_tail(a, 13)).otherwise(F.lit(0.0)),
        TARGET: F.lit(0.0),
    })
    return prepare(df.drop("_a", "_ws"))


def residual_std(pred: DataFrame) -> Column:
    """F22 input: sample std of backtest residuals (1.0 if there are none)."""
    return F.coalesce(pred.select(F.stddev_samp("residual")).scalar(), F.lit(1.0))


def forecast_table(future: DataFrame, forecast: Column, resid_std: Column, seasonal_lag: int = 52) -> DataFrame:
    """Interval, baseline column and the 20-column projection."""
    df = future.withColumn("forecast_units", forecast)
    df = df.withColumns({
        "forecast_lower_80": clip(F.col("forecast_units") - INTERVAL_Z * resid_std, 0.0),
        "forecast_upper_80": F.col("forecast_units") + INTERVAL_Z * resid_std,
        "baseline_forecast": baseline_forecast(seasonal_lag),
        "horizon_week": F.col("horizon_week").cast("int"),
    })
    return df.select(*FORECAST_COLUMNS)


def baseline_run(weekly: DataFrame, params: Params = Params()) -> dict[str, DataFrame]:
    """Backtest + forecast with the seasonal-naive baseline as the forecast."""
    check_lags(params)
    prepared = prepare(weekly)
    train, test = holdout_split(prepared, params.horizon_weeks)
    pred = backtest_frame(test, baseline_forecast(params.seasonal_lag_weeks), params.seasonal_lag_weeks)
    train_rows = train.select(F.count(F.lit(1))).scalar()
    future = future_frame(prepared, params.horizon_weeks, params.lags)
    fc = forecast_table(future, baseline_forecast(params.seasonal_lag_weeks), residual_std(pred),
                        params.seasonal_lag_weeks)
    return {"prepared": prepared, "train": train, "test": test, "backtest": pred,
            "metrics": metrics(pred, train_rows, params.horizon_weeks, "seasonal_naive"), "forecasts": fc}


# ---------------------------------------------------------------- F4-F7, F16, F21
def ridge_run(weekly: DataFrame, params: Params = Params(), features: str = "full") -> dict[str, DataFrame]:
    """F4-F7, F9, F13-F16, F21-F22, F24 with the ridge model; both fits are solved from one pass over the weeks."""
    numeric = NUMERIC_FEATURES if features == "full" else LEAK_FREE_NUMERIC
    check_lags(params)
    prepared = prepare(weekly)
    _, test = holdout_split(prepared, params.horizon_weeks)
    found = sufficient_statistics(prepared, numeric, CATEGORICAL_FEATURES, TARGET,
                                  F.col("week_start") >= test_start(prepared, params.horizon_weeks))
    stats = RidgeStatistics(found, numeric, CATEGORICAL_FEATURES, params.one_hot_min_frequency)
    model, final = [RidgeModel(numeric, CATEGORICAL_FEATURES, params.ridge_alpha, params.one_hot_min_frequency, TARGET).solve(stats, fit)
                    for fit in ("train", "all")]                                          # F6, F16
    pred = backtest_frame(model.predict(test), F.col("prediction"), params.seasonal_lag_weeks)
    future = final.predict(future_frame(prepared, params.horizon_weeks, params.lags))
    fc = forecast_table(future, F.col("prediction"), residual_std(pred), params.seasonal_lag_weeks)
    return {"backtest": pred, "metrics": metrics(pred, F.lit(model.rows).cast("bigint"), params.horizon_weeks), "forecasts": fc,
            "model": model, "final_model": final}


__all__ = ["prepare", "holdout_split", "baseline_forecast", "backtest_frame", "metrics", "future_frame",
           "forecast_table", "baseline_run", "ridge_run", "RidgeModel", "nan_to_null"]
