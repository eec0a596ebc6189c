"""Report, lookup and dashboard-view queries.

Views read the batch outputs: risk scores and forecasts of the baseline
run (oracle-checkable), the weekly features, customer segments and the
sales extract.  Parameters (filters, scenarios) are fixed per query.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stockpulse.operators import views as V
from stockpulse.operators import risk as rk
from stockpulse.plans.catalogue import register
from stockpulse.plans.q_forecast import _baseline, _risk

# query parameters
FILTER = dict(categories=["ECONOMY", "PROMO", "STANDARD"], priority_floor=10.0, stockout_floor=0.2,
              search="Brand#1")
FILTER_SQL = ("category IN ('ECONOMY', 'PROMO', 'STANDARD') AND priority_score >= 10.0 AND stockout_risk >= 0.2 "
              "AND (lower(sku_id) LIKE '%brand#1%' OR lower(CAST(sku_name AS VARCHAR)) LIKE '%brand#1%')")
DATE_FROM, DATE_TO = "1996-01-01", "2000-12-31"
OPTION_CATEGORIES = ["PROMO", "SMALL"]
SCENARIOS = [
    {"scenario_id": 1, "discount_change": 10, "ad_change": 20, "lead_time_change": 0, "service_level": 0.95},
    {"scenario_id": 2, "discount_change": -40, "ad_change": -50, "lead_time_change": 7, "service_level": 0.80},
    {"scenario_id": 3, "discount_change": 0, "ad_change": 0, "lead_time_change": -7, "service_level": 0.92},
]
DRILL_SEGMENT = "Hibernating"
DRILL_CATEGORY = "PROMO"
SEARCH_TEXT = "promo"
WEEKLY_COLUMNS = [
    "sku_id", "sku_name", "category", "subcategory", "brand", "launch_date", "unit_cost", "list_price", "week_start",
    "units_sold", "revenue", "avg_unit_price", "promo_days", "avg_discount", "ad_spend", "page_views", "return_units",
    "stockout_days", "unique_customers", "month", "week", "campaign_intensity", "holiday_days", "weekend_days",
    "on_hand_units", "on_order_units", "lead_time_days", "reorder_point", "damaged_units", "reserved_units",
    "warehouse_zone", "gross_margin", "lag_1", "lag_2", "lag_4", "lag_8", "lag_13", "lag_26", "lag_52",
    "rolling_4_mean", "rolling_8_mean", "rolling_13_std", "sell_through_proxy", "inventory_cover_weeks",
]


def _money_sql(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN '₹0' "
            f"WHEN ABS({x}) >= 1e7 THEN '₹' || format('{{:,.2f}}', {x} / 1e7) || ' Cr' "
            f"WHEN ABS({x}) >= 1e5 THEN '₹' || format('{{:,.2f}}', {x} / 1e5) || ' L' "
            f"ELSE '₹' || format('{{:,.0f}}', {x}) END")


def _scenarios_sql() -> str:
    rows = ", ".join(f"({s['scenario_id']}, {float(s['discount_change'])}, {float(s['ad_change'])}, "
                     f"{float(s['lead_time_change'])}, {float(s['service_level'])})" for s in SCENARIOS)
    return f"(VALUES {rows}) AS sc(scenario_id, discount_change, ad_change, lead_time_change, service_level)"


def _z_sql(x: str) -> str:
    whens = " ".join(f"WHEN ROUND({x}, 2) = {k} THEN {v}" for k, v in V.Z_BY_SERVICE_LEVEL.items())
    return f"CASE {whens} ELSE {V.DEFAULT_Z} END"


_DU = f"(1 + GREATEST(discount_change, {float(V.DISCOUNT_FLOOR_PCT)}) * {V.DISCOUNT_UPLIFT_PER_PCT})"
_AU = f"(1 + ad_change * {V.AD_UPLIFT_PER_PCT})"

CTES = [
    ("met", """
  SELECT CASE WHEN GROUPING(category) = 1 THEN 'overall' ELSE category END AS scope,
         CASE WHEN SUM(ABS(units_sold)) = 0 THEN AVG(ABS(units_sold - model_forecast))
              ELSE SUM(ABS(units_sold - model_forecast)) / SUM(ABS(units_sold)) END AS model_wape,
         CASE WHEN SUM(ABS(units_sold)) = 0 THEN AVG(ABS(units_sold - seasonal_naive_forecast))
              ELSE SUM(ABS(units_sold - seasonal_naive_forecast)) / SUM(ABS(units_sold)) END AS baseline_wape
  FROM bt GROUP BY ROLLUP (category)"""),
    ("sel", f"\n  SELECT * FROM risk WHERE {FILTER_SQL}"),
    ("dstd", """
  SELECT sku_id, STDDEV_SAMP(units_sold) AS demand_std
  FROM (SELECT sku_id, units_sold, row_number() OVER (PARTITION BY sku_id ORDER BY week_start DESC) AS _r FROM weekly)
  WHERE _r <= 12 GROUP BY sku_id"""),
    ("sweep0", f"""
  SELECT sc.scenario_id, r.sku_id, r.forecast_8w_units, r.available_units, r.sales_at_risk_rupees,
         COALESCE(d.demand_std, 0.0) AS demand_std,
         GREATEST(0.0, r.forecast_8w_units * {_DU} * {_AU}) AS simulated_forecast,
         GREATEST(1.0, r.lead_time_days + lead_time_change) AS sim_lead_time_days,
         {_z_sql('service_level')} AS z
  FROM risk r LEFT JOIN dstd d ON d.sku_id = r.sku_id, {_scenarios_sql()}"""),
    ("sweep1", f"""
  SELECT *, simulated_forecast * (sim_lead_time_days / {V.LEAD_HORIZON_DAYS}) AS leadtime_demand,
         z * demand_std * SQRT(sim_lead_time_days / 7) AS safety_stock
  FROM sweep0"""),
]


def _risk_cols(*cols):
    return ", ".join(cols)


# ---------------------------------------------------------------- D1-D3, D9
@register("portfolio_filter", covers="D1", sql="SELECT * FROM sel")
def portfolio_filter(ctx):
    """Category / floor / text-search filter over the risk table."""
    return V.filter_portfolio(_risk(ctx), **FILTER)


@register("filtered_weekly", covers="D2, D9", r2=["revenue"], sql=f"""
SELECT week_start, SUM(units_sold) AS units_sold, SUM(revenue) AS revenue FROM weekly
WHERE sku_id IN (SELECT sku_id FROM sel) AND week_start BETWEEN DATE '{DATE_FROM}' AND DATE '{DATE_TO}'
GROUP BY week_start ORDER BY week_start""")
def filtered_weekly(ctx):
    """SKU selection propagated to the weekly table (semi join + date window), weekly trend."""
    sel = V.filter_portfolio(_risk(ctx), **FILTER)
    return V.weekly_trend(V.propagate_selection(sel, ctx.weekly, DATE_FROM, DATE_TO))


@register("filtered_forecasts", covers="D2", r4=["forecast_units"], sql="""
SELECT sku_id, week_start, horizon_week, forecast_units FROM fcb WHERE sku_id IN (SELECT sku_id FROM sel)""")
def filtered_forecasts(ctx):
    """SKU selection propagated to the forecast rows."""
    sel = V.filter_portfolio(_risk(ctx), **FILTER)
    return V.propagate_selection(sel, _baseline(ctx)["forecasts"]).select(
        "sku_id", "week_start", "horizon_week", "forecast_units")


@register("filter_options", covers="D3", sql=f"""
SELECT DISTINCT * FROM (
  SELECT 'category' AS option, category AS value FROM risk
  UNION ALL SELECT 'subcategory', subcategory FROM risk WHERE category IN ('PROMO', 'SMALL')
  UNION ALL SELECT 'recommended_action', recommended_action FROM risk) WHERE value IS NOT NULL
ORDER BY 1, 2""")
def filter_options(ctx):
    """Distinct sorted option lists, subcategories dependent on chosen categories."""
    return V.filter_options(_risk(ctx), OPTION_CATEGORIES)


# ---------------------------------------------------------------- D4-D14
@register("kpi_block", covers="D4, P2", r4=["model_wape", "baseline_wape", "wape_improvement"],
          r2=["sales_at_risk", "locked_capital"], sql=f"""
SELECT (SELECT model_wape FROM met WHERE scope = 'overall') AS model_wape,
       (SELECT baseline_wape FROM met WHERE scope = 'overall') AS baseline_wape,
       1.0 - CASE WHEN COALESCE(GREATEST((SELECT baseline_wape FROM met WHERE scope = 'overall'), 1e-9), 0) <> 0
                  THEN (SELECT model_wape FROM met WHERE scope = 'overall')
                       / GREATEST((SELECT baseline_wape FROM met WHERE scope = 'overall'), 1e-9)
                  ELSE 0.0 END AS wape_improvement,
       COALESCE(SUM(sales_at_risk_rupees), 0.0) AS sales_at_risk,
       COALESCE(SUM(locked_capital_rupees), 0.0) AS locked_capital,
       COUNT(*) FILTER (WHERE recommended_action = '{rk.ACTION_REORDER}') AS reorder_count,
       COUNT(*) FILTER (WHERE recommended_action = '{rk.ACTION_MARKDOWN}') AS markdown_count
FROM risk""")
def kpi_block(ctx):
    """Headline KPI row."""
    return V.kpi_block(_risk(ctx), _baseline(ctx)["metrics"])


@register("action_mix", covers="D5, D20", r2=["sales_at_risk", "locked_capital"], r4=["avg_priority"], sql="""
SELECT recommended_action, COUNT(DISTINCT sku_id) AS skus, SUM(sales_at_risk_rupees) AS sales_at_risk,
       SUM(locked_capital_rupees) AS locked_capital, AVG(priority_score) AS avg_priority
FROM risk GROUP BY recommended_action ORDER BY skus DESC, recommended_action""")
def action_mix(ctx):
    """SKUs, impact and mean priority per recommended action."""
    return V.action_mix(_risk(ctx))


def _rollup_sql(leaf: str) -> str:
    return f"""
SELECT recommended_action, category, {leaf}, SUM(priority_score) AS priority_total, COUNT(*) AS skus,
       SUM(priority_score * stockout_risk) / NULLIF(SUM(priority_score), 0) AS weighted_stockout,
       CAST(CASE GROUPING(recommended_action, category, {leaf}) WHEN 7 THEN 0 WHEN 3 THEN 1 WHEN 1 THEN 2 ELSE 3 END
            AS INTEGER) AS level
FROM risk GROUP BY ROLLUP (recommended_action, category, {leaf})"""


@register("risk_rollup", covers="D6", r2=["priority_total"], r4=["weighted_stockout"], sql=_rollup_sql("subcategory"))
def risk_rollup(ctx):
    """Rollup action -> category -> subcategory (sunburst) with weighted stockout."""
    return V.risk_rollup(_risk(ctx), "subcategory")


@register("risk_treemap", covers="D6", r2=["priority_total"], r4=["weighted_stockout"], sql=_rollup_sql("sku_id"))
def risk_treemap(ctx):
    """Rollup action -> category -> SKU (tree map) with weighted stockout."""
    return V.risk_rollup(_risk(ctx), "sku_id")


@register("highlights", covers="D7", r2=["forecast_8w_units"], r4=["avg_stockout_risk", "avg_overstock_risk"], sql="""
SELECT (SELECT sku_id FROM risk ORDER BY priority_score DESC, sku_id LIMIT 1) AS most_urgent_sku,
       SUM(forecast_8w_units) AS forecast_8w_units, AVG(stockout_risk) AS avg_stockout_risk,
       AVG(overstock_risk) AS avg_overstock_risk
FROM risk""")
def highlights(ctx):
    """Most urgent SKU, horizon units and mean risks."""
    return V.highlights(_risk(ctx))


@register("category_impact", covers="D8", r2=["sales_at_risk", "locked_capital"], sql="""
SELECT category, SUM(sales_at_risk_rupees) AS sales_at_risk, SUM(locked_capital_rupees) AS locked_capital,
       COUNT(DISTINCT sku_id) AS skus
FROM risk GROUP BY category ORDER BY sales_at_risk DESC, category""")
def category_impact(ctx):
    """Rupee impact by category."""
    return V.category_impact(_risk(ctx))


@register("top_actions", covers="D10, D31", sql=f"""
SELECT sku_id, sku_name, category, recommended_action, reason, recommended_order_qty, markdown_candidate_units,
       {_money_sql('sales_at_risk_rupees')} AS sales_at_risk, {_money_sql('locked_capital_rupees')} AS locked_capital,
       priority_score
FROM risk ORDER BY priority_score DESC, sku_id LIMIT 12""")
def top_actions(ctx):
    """Top-12 recommendation list with money formatting."""
    return V.top_actions(_risk(ctx), 12)


@register("top_risk", covers="P4", sql="""
SELECT sku_id, category, recommended_action, priority_score, sales_at_risk_rupees, locked_capital_rupees
FROM risk ORDER BY priority_score DESC, sku_id LIMIT 10""")
def top_risk(ctx):
    """Top-10 risk list of the report."""
    return (_risk(ctx).orderBy(F.desc("priority_score"), "sku_id").limit(10)
            .select("sku_id", "category", "recommended_action", "priority_score", "sales_at_risk_rupees",
                    "locked_capital_rupees"))


@register("sku_series", covers="D11", r4=["units"], sql="""
SELECT sku_id, week_start, 'actual' AS series, units_sold AS units
FROM (SELECT *, row_number() OVER (PARTITION BY sku_id ORDER BY week_start DESC) AS _r FROM weekly) WHERE _r <= 70
UNION ALL
SELECT sku_id, week_start, 'forecast', forecast_units FROM fcb""")
def sku_series(ctx):
    """Last 70 actual weeks then the forecast horizon, per SKU."""
    return V.sku_series(ctx.weekly, _baseline(ctx)["forecasts"], 70)


@register("sku_compare", covers="D12", r4=["forecast_units"], sql="""
SELECT sku_id, week_start, horizon_week, forecast_units FROM fcb
WHERE sku_id IN (SELECT sku_id FROM risk ORDER BY priority_score DESC, sku_id LIMIT 6)""")
def sku_compare(ctx):
    """Forecast rows of the six highest-priority SKUs."""
    return V.sku_compare(_risk(ctx), _baseline(ctx)["forecasts"], 6)


@register("backtest_trend", covers="D13", r4=["model", "baseline"], sql="""
SELECT week_start, AVG(abs_error_model / GREATEST(units_sold, 1.0)) AS model,
       AVG(abs_error_baseline / GREATEST(units_sold, 1.0)) AS baseline
FROM bt GROUP BY week_start ORDER BY week_start""")
def backtest_trend(ctx):
    """Mean point error per backtest week."""
    return V.backtest_trend(_baseline(ctx)["backtest"])


@register("priority_pivot", covers="D14", r4=V.ACTIONS, sql="SELECT category, " + ", ".join(
    f"COALESCE(AVG(priority_score) FILTER (WHERE recommended_action = '{a}'), 0.0) AS \"{a}\"" for a in V.ACTIONS)
    + " FROM risk GROUP BY category")
def priority_pivot(ctx):
    """Category x action mean priority."""
    return V.priority_pivot(_risk(ctx))


# ---------------------------------------------------------------- D15-D16
@register("scenario_sweep", covers="D15, D16", r4=["simulated_forecast", "sim_lead_time_days", "leadtime_demand",
                                                    "demand_std", "z", "safety_stock", "simulated_sales"], sql=f"""
SELECT scenario_id, sku_id, simulated_forecast, sim_lead_time_days, leadtime_demand, demand_std, z, safety_stock,
       CAST(GREATEST(0, CEIL(leadtime_demand + safety_stock - available_units)) AS BIGINT) AS suggested_order,
       simulated_forecast * COALESCE(CASE WHEN forecast_8w_units <> 0
                                          THEN sales_at_risk_rupees / GREATEST(forecast_8w_units, 1.0) END, 0.0)
         AS simulated_sales,
       CASE WHEN GREATEST(0, CEIL(leadtime_demand + safety_stock - available_units)) > 0 THEN 'order'
            WHEN available_units > simulated_forecast * {V.MARKDOWN_COVER} THEN 'markdown'
            ELSE 'balanced' END AS decision_note
FROM sweep1""")
def scenario_sweep(ctx):
    """What-if simulator swept over every SKU and three scenarios."""
    return V.scenario_sweep(_risk(ctx), ctx.weekly, SCENARIOS)


@register("scenario_curve", covers="D16", r4=["forecast_units", "simulated_units"], sql=f"""
SELECT scenario_id, sku_id, week_start, forecast_units, forecast_units * {_DU} * {_AU} AS simulated_units
FROM fcb, {_scenarios_sql()}""")
def scenario_curve(ctx):
    """Base vs simulated weekly demand per scenario."""
    return V.scenario_curve(_baseline(ctx)["forecasts"], SCENARIOS)


# ---------------------------------------------------------------- D17-D23
@register("segment_view", covers="D17", r2=["revenue"], r4=["avg_churn_risk", "avg_return_rate"], sql="""
SELECT segment, COUNT(DISTINCT customer_id) AS customers, SUM(monetary) AS revenue, SUM(units) AS units,
       AVG(churn_risk) AS avg_churn_risk, AVG(return_rate) AS avg_return_rate
FROM cust GROUP BY segment ORDER BY revenue DESC""")
def segment_view(ctx):
    """Segment table of the customer page."""
    return V.segment_view(ctx.customers)


@register("customer_kpis", covers="D17, D33", r2=["customer_revenue"], r4=["avg_return_rate", "avg_churn_risk"], sql="""
SELECT COUNT(DISTINCT customer_id) AS customers, COALESCE(SUM(monetary), 0.0) AS customer_revenue,
       COUNT(*) FILTER (WHERE churn_risk > 0.7) AS high_churn_customers, AVG(return_rate) AS avg_return_rate,
       AVG(churn_risk) AS avg_churn_risk
FROM cust""")
def customer_kpis(ctx):
    """Customer KPI row (count, value, high churn, return rate, churn)."""
    return V.customer_kpis(ctx.customers)


@register("segment_drill", covers="D18", r2=["monetary", "segment_revenue"],
          r4=["churn_risk", "avg_discount", "return_rate"], sql=f"""
SELECT *, COUNT(*) OVER () AS segment_customers, SUM(monetary) OVER () AS segment_revenue
FROM cust WHERE segment = '{DRILL_SEGMENT}' ORDER BY churn_risk DESC, customer_id""")
def segment_drill(ctx):
    """One segment's customers, highest churn first, with count and revenue."""
    return V.segment_drill(ctx.customers, DRILL_SEGMENT)


def _hist_sql(table: str, x: str, bins: int, by: str = "") -> str:
    lo, hi = f"(SELECT MIN({x}) FROM {table})", f"(SELECT MAX({x}) FROM {table})"
    keys = f"{by}, " if by else ""
    return f"""
SELECT {keys}bucket, COUNT(*) AS count,
       {lo} + (bucket - 1) * ({hi} - {lo}) / {bins} AS bin_low, {lo} + bucket * ({hi} - {lo}) / {bins} AS bin_high
FROM (SELECT *, CAST(CASE WHEN {hi} = {lo} THEN 1
                          ELSE LEAST(CAST(FLOOR(({x} - {lo}) * {bins} / ({hi} - {lo})) AS INTEGER) + 1, {bins}) END
                     AS INTEGER) AS bucket
      FROM {table} WHERE {x} IS NOT NULL)
GROUP BY {keys}bucket ORDER BY {keys}bucket"""


@register("churn_histogram", covers="D19", r4=["bin_low", "bin_high"], sql=_hist_sql("cust", "churn_risk", 20, "segment"))
def churn_histogram(ctx):
    """20-bin churn-risk histogram per segment."""
    return V.histogram(ctx.customers, "churn_risk", 20, ["segment"])


@register("units_histogram", covers="D19, D23", r4=["bin_low", "bin_high"], sql=_hist_sql("weekly", "units_sold", 40))
def units_histogram(ctx):
    """40-bin histogram of a numeric column (weekly units)."""
    return V.histogram(ctx.weekly, "units_sold", 40)


@register("retention_queue", covers="D21", r2=["monetary"], r4=["churn_risk", "avg_discount", "return_rate"], sql="""
SELECT * FROM cust ORDER BY churn_risk DESC, monetary DESC, customer_id LIMIT 80""")
def retention_queue(ctx):
    """Top-80 retention list."""
    return V.retention_queue(ctx.customers, 80)


@register("data_health", covers="D22", sql="SELECT COUNT(*) AS rows, " + str(len(WEEKLY_COLUMNS)) + " AS columns, "
          + "COALESCE(" + " + ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL)" for c in WEEKLY_COLUMNS)
          + ", 0) AS missing_cells, COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM weekly)) AS duplicate_rows"
          + " FROM weekly")
def data_health(ctx):
    """Rows, columns, missing cells and duplicate rows of the weekly table."""
    return V.data_health(ctx.weekly.select(*WEEKLY_COLUMNS))


@register("missing_profile", covers="D23", r4=["missing_pct"], sql="SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS missing_pct FROM weekly"
    for c in WEEKLY_COLUMNS) + ") WHERE missing_pct > 0 ORDER BY missing_pct DESC, \"column\" LIMIT 20")
def missing_profile(ctx):
    """Missing-value percentage per column of the weekly table (top 20)."""
    return V.missing_profile(ctx.weekly.select(*WEEKLY_COLUMNS))


# ---------------------------------------------------------------- D24-D38
@register("meeting_summary", covers="D24", sql="""
SELECT COUNT(DISTINCT sku_id) AS skus,
       (SELECT category FROM risk GROUP BY category ORDER BY SUM(sales_at_risk_rupees) DESC, category LIMIT 1)
         AS top_category,
       (SELECT sku_id FROM risk ORDER BY priority_score DESC, sku_id LIMIT 1) AS top_sku,
       (SELECT sku_name FROM risk ORDER BY priority_score DESC, sku_id LIMIT 1) AS top_sku_name,
       (SELECT recommended_action FROM risk ORDER BY priority_score DESC, sku_id LIMIT 1) AS top_action
FROM risk""")
def meeting_summary(ctx):
    """Top category by sales at risk and the top-priority SKU."""
    return V.meeting_summary(_risk(ctx))


@register("question_answers", covers="D25", r4=["value"], sql=f"""
SELECT 'reorder' AS question, CAST(row_number() OVER (ORDER BY priority_score DESC, sku_id) AS INTEGER) AS rank,
       sku_id AS item, stockout_risk AS value
FROM (SELECT * FROM risk WHERE recommended_action ILIKE '%reorder%' ORDER BY priority_score DESC, sku_id LIMIT 8)
UNION ALL
SELECT 'overstock', CAST(row_number() OVER (ORDER BY overstock_risk DESC, sku_id) AS INTEGER), sku_id, overstock_risk
FROM (SELECT * FROM risk ORDER BY overstock_risk DESC, sku_id LIMIT 8)
UNION ALL
SELECT 'churn', 1, segment, avg_churn
FROM (SELECT segment, AVG(churn_risk) AS avg_churn FROM cust GROUP BY segment ORDER BY avg_churn DESC, segment LIMIT 1)
UNION ALL
SELECT 'accuracy', 1, 'baseline_wape', baseline_wape FROM met WHERE scope = 'overall'
UNION ALL
SELECT 'accuracy', 2, 'model_wape', model_wape FROM met WHERE scope = 'overall'
UNION ALL
SELECT 'impact', 1, 'reorder_skus',
       CAST(COUNT(DISTINCT CASE WHEN recommended_action ILIKE '%reorder%' THEN sku_id END) AS DOUBLE) FROM risk
UNION ALL
SELECT 'impact', 2, 'total_locked_capital', SUM(locked_capital_rupees) FROM risk
UNION ALL
SELECT 'impact', 3, 'total_sales_at_risk', SUM(sales_at_risk_rupees) FROM risk
UNION ALL
SELECT 'category', 1, category, s FROM (SELECT category, SUM(sales_at_risk_rupees) AS s FROM risk GROUP BY category
                                         ORDER BY s DESC, category LIMIT 1)
UNION ALL
SELECT 'region', 1, region, s FROM (SELECT region, SUM(revenue) AS s FROM sales0 WHERE region IS NOT NULL
                                     GROUP BY region ORDER BY s DESC, region LIMIT 1)""")
def question_answers(ctx):
    """Backing queries of the canned business questions, as (question, rank, item, value)."""
    return V.question_answers(_risk(ctx), ctx.customers, _baseline(ctx)["metrics"], ctx.raw["sales_daily"])


@register("category_drill", covers="D26", sql=f"""
SELECT sku_id, sku_name, category, subcategory, recommended_action, stockout_risk, overstock_risk, forecast_8w_units,
       available_units, recommended_order_qty, sales_at_risk_rupees, locked_capital_rupees, priority_score, reason
FROM risk WHERE category = '{DRILL_CATEGORY}'""")
def category_drill(ctx):
    """Category -> SKU drill-down rows."""
    return V.category_drill(_risk(ctx), DRILL_CATEGORY)


@register("region_sales", covers="D27, D28", r2=["sales_value"], sql="""
SELECT g.region, g.sales_value, c.lat, c.lon
FROM (SELECT region, SUM(revenue) AS sales_value FROM sales0 WHERE region IS NOT NULL GROUP BY region) g
LEFT JOIN (VALUES """ + ", ".join(f"('{r}', {a}, {b})" for r, a, b in V.REGION_COORDINATES) + """) AS c(region, lat, lon)
  ON c.region = g.region""")
def region_sales(ctx):
    """Sales value by region with coordinates."""
    return V.region_sales(ctx.raw["sales_daily"])


@register("channel_sales", covers="D29", r2=["sales_value"], sql="""
SELECT sales_channel, SUM(revenue) AS sales_value FROM sales0 WHERE sales_channel IS NOT NULL
GROUP BY sales_channel ORDER BY sales_value DESC, sales_channel""")
def channel_sales(ctx):
    """Sales value by channel."""
    s = ctx.raw["sales_daily"]
    return V.group_sum(s, "sales_channel", V.value_column(s))


@register("category_revenue", covers="D29", r2=["sales_value"], sql="""
SELECT k.category, SUM(s.revenue) AS sales_value FROM sales0 s JOIN sku1 k ON k.sku_id = s.sku_id
GROUP BY k.category ORDER BY sales_value DESC, k.category""")
def category_revenue(ctx):
    """Sales value by category (sales joined to the SKU master first)."""
    s = ctx.raw["sales_daily"].join(ctx.cleaned["sku_master"].select("sku_id", "category"), "sku_id")
    return V.group_sum(s, "category", V.value_column(s))


@register("sales_trend", covers="D30", r2=["sales_value"], sql="""
SELECT date, SUM(revenue) AS sales_value FROM sales0 WHERE date IS NOT NULL GROUP BY date ORDER BY date""")
def sales_trend(ctx):
    """Sales value by day."""
    return V.sales_trend(ctx.raw["sales_daily"])


@register("sales_calendar", covers="D30", r2=["sales_value"], sql="""
SELECT CASE GROUPING(month, quarter, day_name) WHEN 3 THEN 'month' WHEN 5 THEN 'quarter' ELSE 'day_name' END
         AS grain,
       COALESCE(month, quarter, day_name) AS bucket, SUM(v) AS sales_value
FROM (SELECT strftime(date, '%Y-%m') AS month, CAST(quarter(date) AS VARCHAR) AS quarter, dayname(date) AS day_name,
             revenue AS v FROM sales0 WHERE date IS NOT NULL)
GROUP BY GROUPING SETS ((month), (quarter), (day_name))""")
def sales_calendar(ctx):
    """Sales value by month, quarter and day name."""
    return V.sales_calendar(ctx.raw["sales_daily"])


@register("executive_page", covers="D32", r2=["total_sales", "sales_at_risk", "locked_capital"], sql="""
SELECT (SELECT COALESCE(SUM(revenue), 0.0) FROM sales0) AS total_sales,
       COALESCE(SUM(sales_at_risk_rupees), 0.0) AS sales_at_risk,
       COALESCE(SUM(locked_capital_rupees), 0.0) AS locked_capital,
       COUNT(DISTINCT CASE WHEN regexp_matches(recommended_action, '(?i)reorder') THEN sku_id END) AS reorder_skus,
       COUNT(DISTINCT CASE WHEN regexp_matches(recommended_action, '(?i)markdown|clear') THEN sku_id END)
         AS markdown_skus
FROM risk""")
def executive_page(ctx):
    """Executive KPI row."""
    return V.executive_page(ctx.raw["sales_daily"], _risk(ctx))


@register("executive_categories", covers="D32", r2=["sales_at_risk", "locked_capital"], r4=["avg_stockout"], sql="""
SELECT category, SUM(sales_at_risk_rupees) AS sales_at_risk, SUM(locked_capital_rupees) AS locked_capital,
       AVG(stockout_risk) AS avg_stockout, COUNT(DISTINCT sku_id) AS sku_count
FROM risk GROUP BY category ORDER BY sales_at_risk DESC, category""")
def executive_categories(ctx):
    """Executive category summary with mean stockout risk."""
    return V.executive_categories(_risk(ctx))


def _pairs_sql() -> str:
    pairs = [(a, b) for i, a in enumerate(V.BEHAVIOUR) for b in V.BEHAVIOUR[i + 1:]]
    return " UNION ALL ".join(f"SELECT '{a} / {b}' AS pair, customer_id, segment, CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y FROM cust"
                              for a, b in pairs)


@register("customer_pairs", covers="D34", r4=["x", "y"], sql=_pairs_sql())
def customer_pairs(ctx):
    """Every customer in the chart of every two behaviour measures."""
    return V.customer_pairs(ctx.customers)


@register("revenue_page", covers="D35", r2=["total_revenue"], r4=["avg_discount"], sql="""
SELECT COALESCE(SUM(revenue), 0.0) AS total_revenue,
       CASE WHEN AVG(discount_pct) > 1 THEN AVG(discount_pct) / 100 ELSE AVG(discount_pct) END AS avg_discount,
       COALESCE(SUM(return_units), 0.0) AS returned_units
FROM sales0""")
def revenue_page(ctx):
    """Revenue KPI row."""
    return V.revenue_page(ctx.raw["sales_daily"])


@register("locked_capital_top", covers="D35", sql="""
SELECT sku_id, sku_name, category, locked_capital_rupees, recommended_action FROM risk
ORDER BY locked_capital_rupees DESC, sku_id LIMIT 15""")
def locked_capital_top(ctx):
    """Top-15 SKUs by locked capital."""
    return V.locked_capital_top(_risk(ctx), 15)


@register("inventory_page", covers="D36", r4=["avg_stockout_risk", "avg_overstock_risk"], sql="""
SELECT AVG(stockout_risk) AS avg_stockout_risk, AVG(overstock_risk) AS avg_overstock_risk,
       COUNT(DISTINCT sku_id) AS sku_count FROM risk""")
def inventory_page(ctx):
    """Inventory KPI row."""
    return V.inventory_page(_risk(ctx))


@register("inventory_table", covers="D36", sql="SELECT " + ", ".join(V.INVENTORY_PAGE_COLUMNS) + " FROM risk")
def inventory_table(ctx):
    """12-column inventory risk projection."""
    return _risk(ctx).select(*V.INVENTORY_PAGE_COLUMNS)


@register("orders_page", covers="D37", sql="""
SELECT COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT customer_id) AS customers,
       COALESCE(SUM(units_sold), 0.0) AS units_sold FROM sales0""")
def orders_page(ctx):
    """Distinct orders and customers, units sold."""
    return V.orders_page(ctx.raw["sales_daily"])


@register("any_column_search", covers="D38", sql=f"""
SELECT * FROM risk WHERE lower(sku_id) LIKE '%{SEARCH_TEXT}%' OR lower(sku_name) LIKE '%{SEARCH_TEXT}%'
   OR lower(category) LIKE '%{SEARCH_TEXT}%' OR lower(subcategory) LIKE '%{SEARCH_TEXT}%'
   OR lower(recommended_action) LIKE '%{SEARCH_TEXT}%' OR lower(reason) LIKE '%{SEARCH_TEXT}%'""")
def any_column_search(ctx):
    """Rows of the risk table where any column contains the text."""
    return V.any_column_search(_risk(ctx), SEARCH_TEXT)


# ---------------------------------------------------------------- A2-A6, P6-P7
@register("sku_list", covers="A2", sql="""
SELECT sku_id, sku_name, category, recommended_action, priority_score FROM risk
ORDER BY priority_score DESC, sku_id LIMIT 50""")
def sku_list(ctx):
    """First 50 SKUs in priority order."""
    return V.sku_list(_risk(ctx), 50)


def _top_ids(ctx, n):
    return V.top_skus(_risk(ctx), n)


@register("sku_detail", covers="A3", r4=["forecast_units"], sql="""
SELECT r.sku_id, r.priority_score, r.recommended_action, f.horizon_week, f.week_start, f.forecast_units
FROM risk r LEFT JOIN fcb f ON f.sku_id = r.sku_id
WHERE r.sku_id IN (SELECT sku_id FROM risk ORDER BY priority_score DESC, sku_id LIMIT 5)""")
def sku_detail(ctx):
    """Risk row and ordered forecast rows of the five top SKUs (forecast array exploded)."""
    d = V.sku_detail(_risk(ctx), _baseline(ctx)["forecasts"], _top_ids(ctx, 5))
    return d.select("sku_id", "priority_score", "recommended_action",
                    F.explode_outer("forecast").alias("f")).select(
        "sku_id", "priority_score", "recommended_action", F.col("f.horizon_week").alias("horizon_week"),
        F.col("f.week_start").alias("week_start"), F.col("f.forecast_units").alias("forecast_units"))


@register("sku_score", covers="A4", sql="SELECT " + ", ".join(V.SCORE_COLUMNS) + """ FROM risk
WHERE sku_id = (SELECT sku_id FROM risk ORDER BY priority_score DESC, sku_id LIMIT 1)""")
def sku_score(ctx):
    """10-column score of the top SKU."""
    risk = _risk(ctx)
    return V.score_sku(risk, V.top_skus(risk, 1).first()["sku_id"])


@register("batch_score", covers="A5", sql="""
SELECT * FROM risk WHERE sku_id IN (SELECT sku_id FROM sku1 WHERE brand IN ('Brand#11', 'Brand#22')
                                    UNION ALL SELECT 'UNKNOWN-SKU')""")
def batch_score(ctx):
    """Risk rows of a requested id list (two brands plus an unknown id)."""
    ids = (ctx.cleaned["sku_master"].where(F.col("brand").isin("Brand#11", "Brand#22")).select("sku_id")
           .unionByName(ctx.spark.createDataFrame([("UNKNOWN-SKU",)], "sku_id string")))
    return V.batch_score(_risk(ctx), ids)


@register("portfolio_summary", covers="A6", r2=["sales_at_risk_rupees", "locked_capital_rupees"], sql="""
SELECT t.sales_at_risk_rupees, t.locked_capital_rupees, t.sku_count, a.action, a.n
FROM (SELECT COALESCE(SUM(sales_at_risk_rupees), 0.0) AS sales_at_risk_rupees,
             COALESCE(SUM(locked_capital_rupees), 0.0) AS locked_capital_rupees,
             COUNT(DISTINCT sku_id) AS sku_count FROM risk) t,
     (SELECT recommended_action AS action, COUNT(*) AS n FROM risk GROUP BY recommended_action) a""")
def portfolio_summary(ctx):
    """Impact totals, distinct SKUs and the action-count map (exploded)."""
    s = V.portfolio_summary(_risk(ctx))
    return s.select("sales_at_risk_rupees", "locked_capital_rupees", "sku_count",
                    F.explode("action_counts").alias("action", "n"))


@register("data_profile", covers="P6", sql="""
SELECT COUNT(*) AS weekly_rows, COUNT(DISTINCT sku_id) AS skus, COUNT(DISTINCT category) AS categories,
       (SELECT COUNT(DISTINCT customer_id) FROM cust) AS customers, (SELECT MAX(horizon_week) FROM fcb) AS max_horizon
FROM weekly""")
def data_profile(ctx):
    """Rows, distinct SKUs / categories / customers, max horizon."""
    return V.data_profile(ctx.weekly, ctx.customers, _baseline(ctx)["forecasts"])


@register("executive_summary", covers="P7", r4=["model_wape", "baseline_wape", "wape_improvement"],
          r2=["sales_at_risk_rupees", "locked_capital_rupees"], sql=f"""
SELECT (SELECT model_wape FROM met WHERE scope = 'overall') AS model_wape,
       (SELECT baseline_wape FROM met WHERE scope = 'overall') AS baseline_wape,
       1.0 - (SELECT model_wape FROM met WHERE scope = 'overall')
             / GREATEST((SELECT baseline_wape FROM met WHERE scope = 'overall'), 1e-9) AS wape_improvement,
       COALESCE(SUM(sales_at_risk_rupees), 0.0) AS sales_at_risk_rupees,
       COALESCE(SUM(locked_capital_rupees), 0.0) AS locked_capital_rupees,
       COUNT(*) FILTER (WHERE recommended_action = '{rk.ACTION_REORDER}') AS reorder_now_skus,
       COUNT(*) FILTER (WHERE recommended_action = '{rk.ACTION_MARKDOWN}') AS markdown_clear_skus,
       (SELECT COUNT(DISTINCT customer_id) FROM cust) AS customers_scored
FROM risk""")
def executive_summary(ctx):
    """One-row executive summary."""
    return V.executive_summary(_baseline(ctx)["metrics"], _risk(ctx), ctx.customers)
