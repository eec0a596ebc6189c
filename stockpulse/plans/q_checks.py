"""Queries that reach the branches the headline queries cannot: other lags,
thresholds and models, absent columns, extracts read from files, the fitted
model's parts, and the remaining listings (D2, D20, D25, D27, D37, P8)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stockpulse.functions import fmt
from stockpulse.operators import clean, features
from stockpulse.operators import forecast as fc
from stockpulse.operators import risk as rk
from stockpulse.operators import views as V
from stockpulse.params import LAGS, Params
from stockpulse.plans.catalogue import register
from stockpulse.plans.q_forecast import _BIAS, _WAPE, H, _baseline, _ridge, _risk
from stockpulse.plans.q_views import FILTER, FILTER_SQL
from stockpulse.session import ensure_checkpoint_dir, materialize
from stockpulse.sources import io

SEASONAL = 104
STRICT = Params(stockout_threshold=0.10, overstock_threshold=0.05, safety_stock_multiplier=4.0)   # all four actions occur
#: One place a region of the driver's tables, by rule (its number in the alphabet).
PLACES = [(r, 10.0 * i, -5.0 * i) for i, r in enumerate(["AFRICA", "AMERICA", "ASIA", "EUROPE"])]
ONE_SKU = "Brand#11|PROMO"

_MEAN4 = "COALESCE(rolling_4_mean, 0)"
_SEASONAL_TAIL = "list_avg(_b[-4:])"


def _ctes() -> list[tuple[str, str]]:
    from stockpulse.plans import q_forecast

    body = dict(q_forecast.CTES)

    strict = body["rk2"].replace("1.15 *", f"{STRICT.safety_stock_multiplier} *")
    last = body["risk"].replace("s >= 0.55", f"s >= {STRICT.stockout_threshold}").replace("s < 0.55", f"s < {STRICT.stockout_threshold}")
    last = last.replace("o >= 0.55", f"o >= {STRICT.overstock_threshold}").replace("o < 0.55", f"o < {STRICT.overstock_threshold}")

    return [
        ("bt2", f"""
  SELECT sku_id, week_start, category, subcategory, units_sold, {_MEAN4} AS model_forecast,
         COALESCE(lag_52, lag_4, rolling_4_mean, 0) AS seasonal_naive_forecast FROM split WHERE is_test"""),
        ("met2", f"""
  SELECT CASE WHEN GROUPING(category) = 1 THEN 'overall' ELSE category END AS scope, 'four_week_mean' AS model,
         {_WAPE.format(f='model_forecast')} AS model_wape, {_WAPE.format(f='seasonal_naive_forecast')} AS baseline_wape,
         {_BIAS.format(f='model_forecast')} AS model_bias,
         CASE WHEN GROUPING(category) = 1 THEN {_BIAS.format(f='seasonal_naive_forecast')} END AS baseline_bias,
         CASE WHEN GROUPING(category) = 1 THEN AVG(ABS(units_sold - model_forecast)) END AS mae,
         CAST({H} AS INTEGER) AS test_weeks, (SELECT COUNT(*) FROM split WHERE NOT is_test) AS train_rows,
         COUNT(*) AS test_rows
  FROM bt2 GROUP BY ROLLUP (category)"""),
        ("srk2", strict),
        ("srk3", body["rk3"].replace("rk2", "srk2")),
        ("srk4", body["rk4"].replace("rk3", "srk3")),
        ("strict_risk", last.replace("rk4", "srk4")),
    ]


CTES = _ctes()


# ---------------------------------------------------------------- rollout
@register("future_frame_lag104", covers="F8, F20", r4=["lag_52", "lag_104", "baseline"], sql=f"""
SELECT sku_id, CAST(step AS INTEGER) AS horizon_week,
       CASE WHEN len(_b) >= 52 THEN _b[-52] WHEN len(_b) >= 4 THEN _b[-4] ELSE {_SEASONAL_TAIL} END AS lag_52,
       CASE WHEN len(_b) >= {SEASONAL} THEN _b[-{SEASONAL}] WHEN len(_b) >= 4 THEN _b[-4] ELSE {_SEASONAL_TAIL} END AS lag_104,
       CASE WHEN len(_b) >= {SEASONAL} THEN _b[-{SEASONAL}] WHEN len(_b) >= 4 THEN _b[-4] ELSE {_SEASONAL_TAIL} END AS baseline
FROM (
  WITH RECURSIVE h0 AS (SELECT sku_id, list(units_sold ORDER BY week_start) AS _b FROM prep GROUP BY sku_id),
  r(sku_id, step, _b) AS (
    SELECT sku_id, 1, _b FROM h0
    UNION ALL
    SELECT sku_id, step + 1, list_append(_b, list_avg(_b[-4:])) FROM r WHERE step < {H})
  SELECT * FROM r)""")
def future_frame_lag104(ctx):
    """Rollout with a two-year seasonal lag beside the default lags."""
    f = fc.future_frame(fc.prepare(ctx.weekly), H, (*LAGS, SEASONAL))
    return f.select("sku_id", F.col("horizon_week").cast("int").alias("horizon_week"), "lag_52", "lag_104",
                    fc.baseline_forecast(SEASONAL).alias("baseline"))


@register("inventory_fill_global", covers="W14", sql="""
SELECT sku_id, week_start, """ + ", ".join(
    f"FIRST_VALUE({c} IGNORE NULLS) OVER (ORDER BY sku_id, week_start ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS {c}"
    for c in features.INVENTORY_COLS) + """
FROM (SELECT sku_id, week_start, """ + ", ".join(
    f"LAST_VALUE({c} IGNORE NULLS) OVER (PARTITION BY sku_id ORDER BY week_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
    for c in features.INVENTORY_COLS) + " FROM wj)")
def inventory_fill_global(ctx):
    """Back fill across SKUs: a SKU without snapshots takes the next SKU's first one."""
    joined = features.joined_week(ctx.cleaned, ctx.weekly_sales)
    return features.fill_inventory(joined, "global").select("sku_id", "week_start", *features.INVENTORY_COLS)


# ---------------------------------------------------------------- a second model
def _second(ctx):
    key = "_second_model"
    if key not in ctx.__dict__:
        train, test = fc.holdout_split(fc.prepare(ctx.weekly), ctx.params.horizon_weeks)
        pred = fc.backtest_frame(test, F.coalesce("rolling_4_mean", F.lit(0.0)))
        count = train.select(F.count(F.lit(1))).scalar()
        ctx.__dict__[key] = (pred, materialize(fc.metrics(pred, count, ctx.params.horizon_weeks, "four_week_mean"), "second-metrics"))
    return ctx.__dict__[key]


@register("metrics_two_models", covers="F10-F15", r4=["model_wape", "baseline_wape", "model_bias", "baseline_bias", "mae"],
          sql="SELECT * FROM met2")
def metrics_two_models(ctx):
    """Backtest metrics of the four-week mean next to the seasonal baseline."""
    return _second(ctx)[1]


@register("kpi_two_models", covers="D4, P2", r4=["model_wape", "baseline_wape", "wape_improvement"], sql="""
SELECT model_wape, baseline_wape, 1 - model_wape / GREATEST(baseline_wape, 1e-9) AS wape_improvement
FROM met2 WHERE scope = 'overall'""")
def kpi_two_models(ctx):
    """Improvement of a model that differs from the baseline."""
    return V.kpi_block(_risk(ctx), _second(ctx)[1]).select("model_wape", "baseline_wape", "wape_improvement")


@register("summary_two_models", covers="P7, P2", r4=["model_wape", "baseline_wape", "wape_improvement"], sql="""
SELECT model_wape, baseline_wape, 1 - model_wape / GREATEST(baseline_wape, 1e-9) AS wape_improvement
FROM met2 WHERE scope = 'overall'""")
def summary_two_models(ctx):
    """The executive summary's model part for a model that differs from the baseline."""
    return V.executive_summary(_second(ctx)[1], _risk(ctx), ctx.customers).select("model_wape", "baseline_wape", "wape_improvement")


@register("backtest_trend_two_models", covers="D13", r4=["model", "baseline"], sql="""
SELECT week_start, AVG(ABS(units_sold - model_forecast) / GREATEST(units_sold, 1.0)) AS model,
       AVG(ABS(units_sold - seasonal_naive_forecast) / GREATEST(units_sold, 1.0)) AS baseline
FROM bt2 GROUP BY week_start""")
def backtest_trend_two_models(ctx):
    """Mean point error a week of two models that differ."""
    return V.backtest_trend(_second(ctx)[0])


# ---------------------------------------------------------------- risk branches
@register("risk_scores_strict", covers="K10", sql="SELECT * FROM strict_risk")
def risk_scores_strict(ctx):
    """Risk scores with thresholds at which all four actions occur."""
    return rk.score_risk(_baseline(ctx)["forecasts"], STRICT, sort=False)


# ---------------------------------------------------------------- absent columns and weeks
@register("inventory_defaults", covers="C13", sql="""
SELECT date, sku_id, on_hand_units, 'Unknown' AS warehouse_zone, 0.0 AS damaged_units, 0.0 AS reserved_units FROM inv1_dirty""")
def inventory_defaults(ctx):
    """Snapshots that lack the optional columns."""
    lacking = ctx.dirty_inventory.drop("warehouse_zone", "damaged_units", "reserved_units")
    return clean.clean_inventory(lacking).select("date", "sku_id", "on_hand_units", "warehouse_zone", "damaged_units", "reserved_units")


@register("calendar_gaps", covers="W25-W26", r4=["campaign_intensity"], sql="""
SELECT w.sku_id, w.week_start, CAST(COALESCE(c.month, month(w.week_start)) AS INTEGER) AS month,
       CAST(COALESCE(c.week, weekofyear(w.week_start)) AS INTEGER) AS week,
       CAST(COALESCE(c.campaign_intensity, 0) AS DOUBLE) AS campaign_intensity,
       CAST(COALESCE(c.holiday_days, 0) AS DOUBLE) AS holiday_days, CAST(COALESCE(c.weekend_days, 2) AS DOUBLE) AS weekend_days
FROM spine w LEFT JOIN (
  SELECT CAST(date_trunc('week', date) AS DATE) AS week_start, MAX(month) AS month, MAX(week) AS week,
         AVG(campaign_intensity) AS campaign_intensity, SUM(CAST(is_holiday AS INTEGER)) AS holiday_days,
         SUM(CAST(is_weekend AS INTEGER)) AS weekend_days
  FROM cal1 WHERE year(date) % 2 = 0 GROUP BY 1) c ON c.week_start = w.week_start""")
def calendar_gaps(ctx):
    """Features with a calendar that lacks every odd year."""
    cleaned = dict(ctx.cleaned, calendar=ctx.cleaned["calendar"].where(F.year("date") % 2 == 0))
    df = features.calendar_fallbacks(features.joined_week(cleaned, ctx.weekly_sales))
    return df.select("sku_id", "week_start", "month", "week", "campaign_intensity", "holiday_days", "weekend_days")


# ---------------------------------------------------------------- extracts from files
@register("extract_from_files", covers="S1-S4, S6, C4", sql="""
SELECT sku_id, category, unit_cost, list_price FROM sku1_dirty""")
def extract_from_files(ctx):
    """The dirtied SKU extract written as CSV, read back by the contract, cleaned in file order."""
    base = ensure_checkpoint_dir(ctx.spark).rstrip("/")
    rows = ctx.dirty_sku.repartitionByRange(4, "_ord").sortWithinPartitions("_ord").drop("_ord")
    path = io.write_table(rows, f"{base}/extract-{uuid.uuid4().hex}.csv", fmt="csv")
    read = io.read_extract(ctx.spark, "sku_master", path, "csv")
    stored = io.write_table(clean.clean_sku(read), f"{base}/sku-{uuid.uuid4().hex}")
    return io.read_table(ctx.spark, stored).select("sku_id", "category", "unit_cost", "list_price")


# ---------------------------------------------------------------- listings
@register("filtered_backtest", covers="D2", r4=["model_forecast"], sql=f"""
SELECT sku_id, week_start, units_sold, model_forecast FROM bt
WHERE sku_id IN (SELECT sku_id FROM risk WHERE {FILTER_SQL})""")
def filtered_backtest(ctx):
    """SKU selection propagated to the backtest rows."""
    chosen = V.filter_portfolio(_risk(ctx), **FILTER)
    return V.propagate_selection(chosen, _baseline(ctx)["backtest"]).select("sku_id", "week_start", "units_sold", "model_forecast")


@register("top_list", covers="D20", sql="SELECT * FROM risk ORDER BY priority_score DESC, sku_id LIMIT 100")
def top_list(ctx):
    """The hundred SKUs of highest priority."""
    return V.top_list(_risk(ctx), 100)


@register("sku_explanation", covers="D25", sql=f"SELECT * FROM risk WHERE sku_id = '{ONE_SKU}'")
def sku_explanation(ctx):
    """The risk row that explains one SKU."""
    return V.found_or_raise(_risk(ctx), ONE_SKU)


@register("region_coordinates", covers="D27", r2=["sales_value"], sql="""
SELECT g.region, g.sales_value, c.lat, c.lon
FROM (SELECT region, SUM(revenue) AS sales_value FROM sales0 WHERE region IS NOT NULL GROUP BY region) g
LEFT JOIN (VALUES """ + ", ".join(f"('{r}', CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))" for r, a, b in PLACES) + """) AS c(region, lat, lon)
  ON c.region = g.region""")
def region_coordinates(ctx):
    """Sales by region with places that match four of the five regions."""
    return V.region_sales(ctx.raw["sales_daily"], PLACES)


@register("order_listing", covers="D37", r2=["revenue"], r4=["unit_price"], sql="SELECT " + ", ".join(V.ORDER_LISTING)
          + " FROM sales0 ORDER BY " + ", ".join(f"{c} NULLS FIRST" for c in V.ORDER_LISTING) + " LIMIT 100")
def order_listing(ctx):
    """The first hundred order lines."""
    return V.order_listing(ctx.raw["sales_daily"], 100)


@register("orders_without_ids", covers="D37", sql="""
SELECT COUNT(*) AS orders, COUNT(DISTINCT customer_id) AS customers, COALESCE(SUM(units_sold), 0.0) AS units_sold FROM sales0""")
def orders_without_ids(ctx):
    """Orders KPI where the extract has no order id: rows are counted."""
    return V.orders_page(ctx.raw["sales_daily"].drop("order_id"))


@register("report_formats", covers="P8", sql="""
SELECT sku_id, '₹' || format('{:,.0f}', sales_at_risk_rupees) AS sales_at_risk,
       format('{:.1f}', CAST(ROUND(stockout_risk * 1000) AS DOUBLE) / 10) || '%' AS stockout FROM risk""")
def report_formats(ctx):
    """Report money and percent formats of every SKU."""
    return _risk(ctx).select("sku_id", fmt.money_plain("sales_at_risk_rupees").alias("sales_at_risk"),
                             fmt.pct(F.round(F.col("stockout_risk") * 1000) / 1000).alias("stockout"))


# ---------------------------------------------------------------- the fitted model
def _stat_sql(c: str) -> str:
    return f"SELECT '{c}' AS feature, AVG({c}) AS mean, CASE WHEN STDDEV_POP({c}) > 0 THEN STDDEV_POP({c}) ELSE 1 END AS scale FROM split WHERE NOT is_test"


@register("ridge_scaling", covers="F4", r4=["mean", "scale"], sql=" UNION ALL ".join(_stat_sql(c) for c in fc.NUMERIC_FEATURES))
def ridge_scaling(ctx):
    """Means and population deviations the model was scaled with."""
    m = _ridge(ctx)["model"]
    return ctx.spark.createDataFrame([(c, m.means[c], m.scales[c]) for c in m.numeric], "feature string, mean double, scale double")


@register("ridge_vocabulary", covers="F5", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS label, COUNT(*) < 5 AS pooled FROM split WHERE NOT is_test GROUP BY {c}"
    for c in fc.CATEGORICAL_FEATURES))
def ridge_vocabulary(ctx):
    """Labels the model saw, and whether they were pooled."""
    return _ridge(ctx)["model"].vocabulary()


def _gram_sql(side: str) -> str:
    names = fc.NUMERIC_FEATURES
    pairs = [f"{{'feature': '{a}', 'other': '{b}', 'product': COALESCE(COVAR_POP({a}, {b}) / NULLIF(STDDEV_POP({a}) * STDDEV_POP({b}), 0), 0)}}"
             for i, a in enumerate(names) for b in names[i:]]
    return f"SELECT unnest([{', '.join(pairs)}], recursive := true) FROM split{side}"


@register("ridge_gram", covers="F4, F6, F16", r4=["product"], sql=f"""
SELECT 'train' AS fit, * FROM ({_gram_sql(" WHERE NOT is_test")}) UNION ALL SELECT 'all', * FROM ({_gram_sql("")})""")
def ridge_gram(ctx):
    """Mean cross products of the scaled numeric features that both fits were solved with."""
    rows = []
    for fit, m in (("train", _ridge(ctx)["model"]), ("all", _ridge(ctx)["final_model"])):
        names = m.numeric
        rows += [(fit, a, b, float(m.gram[i, j]) / m.rows) for i, a in enumerate(names) for j, b in enumerate(names) if j >= i]
    return ctx.spark.createDataFrame(rows, "fit string, feature string, other string, product double")


def _gradient(model, frame):
    """Whether the gradient of the ridge objective vanishes at the fitted weights, from the rows themselves."""
    _, w = model.coefficients()
    residual = F.col("prediction") - F.col(fc.TARGET)
    columns = [(F.col(c) - F.lit(model.means[c])) / F.lit(model.scales[c]) for c in model.numeric]
    for c in model.categorical:
        frequent = model.frequent[c]
        columns += [(F.col(c) == v).cast("double") for v in frequent]
        columns += [(~F.col(c).isin(frequent)).cast("double")] * model.has_pooled[c] + [F.lit(0.0)]
    sums = model.predict(frame, clipped=False).agg(F.sum(residual).alias("g0"), F.sum(F.abs(residual)).alias("all"),
                                                   *[F.sum(x * residual).alias(f"g{i + 1}") for i, x in enumerate(columns)]).first()
    return [(i, bool(abs(sums[f"g{i}"] + (model.alpha * w[i - 1] if i else 0.0)) <= 1e-8 * (1 + sums["all"]))) for i in range(len(w) + 1)]


@register("ridge_optimality", covers="F6, F16", sql="""
SELECT fit, CAST(feature AS INTEGER) AS feature, TRUE AS optimal FROM (
  SELECT 'train' AS fit, unnest(generate_series(0, (
    SELECT CAST(38 + SUM(n) AS BIGINT) FROM (""" + " UNION ALL ".join(
    f"SELECT COUNT(*) FILTER (WHERE k >= 5) + MAX(CASE WHEN k < 5 THEN 1 ELSE 0 END) AS n FROM (SELECT COUNT(*) AS k FROM split WHERE NOT is_test GROUP BY {c})"
    for c in fc.CATEGORICAL_FEATURES) + """)))) AS feature
  UNION ALL
  SELECT 'all', unnest(generate_series(0, (
    SELECT CAST(38 + SUM(n) AS BIGINT) FROM (""" + " UNION ALL ".join(
    f"SELECT COUNT(*) FILTER (WHERE k >= 5) + MAX(CASE WHEN k < 5 THEN 1 ELSE 0 END) AS n FROM (SELECT COUNT(*) AS k FROM split GROUP BY {c})"
    for c in fc.CATEGORICAL_FEATURES) + ")))))")
def ridge_optimality(ctx):
    """Whether the ridge objective's gradient vanishes at the fitted weights, feature by feature (0: intercept)."""
    run = _ridge(ctx)
    prepared = fc.prepare(ctx.weekly)
    train, _ = fc.holdout_split(prepared, ctx.params.horizon_weeks)
    rows = [("train", i, ok) for i, ok in _gradient(run["model"], train)] + [("all", i, ok) for i, ok in _gradient(run["final_model"], prepared)]
    return ctx.spark.createDataFrame(rows, "fit string, feature int, optimal boolean")


@register("ridge_alignment", covers="F7, F21", sql="""
SELECT sku_id, week_start, TRUE AS aligned FROM fut1""")
def ridge_alignment(ctx):
    """Whether each SKU and week carries the prediction its own features give, computed anew from the weights."""
    run = _ridge(ctx)
    model = run["final_model"]
    b0, w = model.coefficients()
    future = fc.future_frame(fc.prepare(ctx.weekly), ctx.params.horizon_weeks, ctx.params.lags)
    value = F.lit(float(b0))
    for i, c in enumerate(model.numeric):
        value = value + F.lit(float(w[i])) * (F.col(c) - model.means[c]) / model.scales[c]
    at = len(model.numeric)
    for c in model.categorical:
        labels = model.labels(c)
        weight = F.lit(0.0)
        for i, label in enumerate(labels):
            hit = ~F.col(c).isin(model.frequent[c]) if label == model.INFREQUENT else F.col(c) == label   # every label of the future was seen
            weight = F.when(hit, F.lit(float(w[at + i]))).otherwise(weight)
        value = value + weight
        at += len(labels) + 1   # a place for labels not seen
    own = future.select("sku_id", "week_start", F.greatest(value, F.lit(0.0)).alias("own"))
    return run["forecasts"].select("sku_id", "week_start", "forecast_units").join(own, ["sku_id", "week_start"]).select(
        "sku_id", "week_start", (F.abs(F.col("own") - F.col("forecast_units")) < 1e-6).alias("aligned"))
