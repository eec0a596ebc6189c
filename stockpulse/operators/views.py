"""Analytic views over the output tables.

Each view is a function of DataFrames (risk scores, forecasts, weekly
features, backtest, customers, sales) returning a DataFrame; none collects.
Only tables with a size fixed by construction are broadcast (the 5-row
region coordinates, the one-row-per-partition offsets); everything else is
left to AQE's measured broadcast decision.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockpulse.functions import fmt
from stockpulse.functions.columns import col
from stockpulse.functions.dedup import distinct_count
from stockpulse.operators.risk import ACTION_HEALTHY, ACTION_MARKDOWN, ACTION_REORDER, ACTION_WATCH
from stockpulse.sources import store

ACTIONS = [ACTION_HEALTHY, ACTION_MARKDOWN, ACTION_REORDER, ACTION_WATCH]

# Service level -> z score of the planning simulator (default 1.41).
Z_BY_SERVICE_LEVEL = {
    0.80: 0.84, 0.81: 0.88, 0.82: 0.92, 0.83: 0.95, 0.84: 0.99, 0.85: 1.04, 0.86: 1.08, 0.87: 1.13,
    0.88: 1.17, 0.89: 1.23, 0.90: 1.28, 0.91: 1.34, 0.92: 1.41, 0.93: 1.48, 0.94: 1.55, 0.95: 1.64,
    0.96: 1.75, 0.97: 1.88, 0.98: 2.05, 0.99: 2.33,
}
DEFAULT_Z = 1.41
# Simulator uplift slopes and cover ratio.
DISCOUNT_UPLIFT_PER_PCT, DISCOUNT_FLOOR_PCT = 0.006, -30
AD_UPLIFT_PER_PCT = 0.0025
LEAD_HORIZON_DAYS = 56
MARKDOWN_COVER = 1.4
HISTORY_WEEKS_FOR_STD = 12
# Region coordinates of the geographic view.
REGION_COORDINATES = [
    ("North", 28.6139, 77.2090),
    ("South", 12.9716, 77.5946),
    ("East", 22.5726, 88.3639),
    ("West", 19.0760, 72.8777),
    ("Central", 23.2599, 77.4126),
]
# Candidate value and date columns, in priority order.
VALUE_COLUMNS = ["sales_amount", "revenue", "net_sales", "amount", "sales_value"]
DATE_COLUMNS = ["date", "order_date", "sales_date", "week_start"]
HIGH_CHURN = 0.70


# ---------------------------------------------------------------- D1-D3
def filter_portfolio(risk: DataFrame, categories=None, subcategories=None, actions=None,
                     priority_floor: float = 0.0, stockout_floor: float = 0.0, search: str | None = None,
                     regex: bool = False) -> DataFrame:
    """Membership filters (empty = no filter), floors, case-insensitive search."""
    df = risk
    if categories:
        df = df.where(F.col("category").isin(list(categories)))
    if subcategories:
        df = df.where(F.col("subcategory").isin(list(subcategories)))
    if actions:
        df = df.where(F.col("recommended_action").isin(list(actions)))
    df = df.where((F.col("priority_score") >= priority_floor) & (F.col("stockout_risk") >= stockout_floor))
    if search and search.strip():
        q = search.strip().lower()
        if regex:
            hit = F.lower("sku_id").rlike(q) | F.lower(F.col("sku_name").cast("string")).rlike(q)
        else:
            hit = F.lower("sku_id").contains(q) | F.lower(F.col("sku_name").cast("string")).contains(q)
        df = df.where(F.coalesce(hit, F.lit(False)))
    return df


def propagate_selection(selected: DataFrame, table: DataFrame, date_start=None, date_end=None) -> DataFrame:
    """Keep rows of ``table`` whose SKU is selected (left-semi join), optional date window."""
    out = table.join(selected.select("sku_id"), "sku_id", "left_semi")
    if date_start is not None and date_end is not None:
        out = out.where(F.col("week_start").between(F.lit(date_start).cast("date"), F.lit(date_end).cast("date")))
    return out


def filter_options(risk: DataFrame, categories=None) -> DataFrame:
    """D3: distinct sorted option lists; subcategories depend on the chosen categories."""
    cats = risk.select(F.lit("category").alias("option"), F.col("category").alias("value"))
    sub_src = risk.where(F.col("category").isin(list(categories))) if categories else risk
    subs = sub_src.select(F.lit("subcategory").alias("option"), F.col("subcategory").alias("value"))
    acts = risk.select(F.lit("recommended_action").alias("option"), F.col("recommended_action").alias("value"))
    return cats.unionByName(subs).unionByName(acts).where(F.col("value").isNotNull()).distinct().orderBy("option", "value")


# ---------------------------------------------------------------- D4-D14
def kpi_block(risk: DataFrame, metrics: DataFrame) -> DataFrame:
    """D4 (+P2): headline KPIs over the filtered portfolio."""
    m = metrics.where(F.col("scope") == "overall").select(
        F.struct(F.first("model_wape").alias("m"), F.first("baseline_wape").alias("b"))).scalar()
    mw, bw = m["m"], m["b"]
    a = F.col("recommended_action")
    return risk.agg(
        mw.alias("model_wape"), bw.alias("baseline_wape"),
        (F.lit(1.0) - fmt.guarded_ratio(mw, F.greatest(bw, F.lit(1e-9)))).alias("wape_improvement"),
        F.coalesce(F.sum("sales_at_risk_rupees"), F.lit(0.0)).alias("sales_at_risk"),
        F.coalesce(F.sum("locked_capital_rupees"), F.lit(0.0)).alias("locked_capital"),
        F.count_if(a == ACTION_REORDER).alias("reorder_count"),
        F.count_if(a == ACTION_MARKDOWN).alias("markdown_count"),
    )


def action_mix(risk: DataFrame) -> DataFrame:
    """D5 (+D20 counts): SKUs, impact and mean priority per action."""
    return (risk.groupBy("recommended_action")
                .agg(F.countDistinct("sku_id").alias("skus"),
                     F.sum("sales_at_risk_rupees").alias("sales_at_risk"),
                     F.sum("locked_capital_rupees").alias("locked_capital"),
                     F.avg("priority_score").alias("avg_priority"))
                .orderBy(F.desc("skus"), "recommended_action"))


def risk_rollup(risk: DataFrame, leaf: str = "subcategory") -> DataFrame:
    """Hierarchical sums action -> category -> leaf, with a priority-weighted
    mean stockout risk per node; ``level`` tells subtotals from NULL keys."""
    p, s = F.col("priority_score"), F.col("stockout_risk")
    g = risk.rollup("recommended_action", "category", leaf).agg(
        F.grouping_id().alias("_gid"),
        F.sum(p).alias("priority_total"),
        F.count(F.lit(1)).alias("skus"),
        F.try_divide(F.sum(p * s), F.sum(p)).alias("weighted_stockout"))
    level = F.when(F.col("_gid") == 7, 0).when(F.col("_gid") == 3, 1).when(F.col("_gid") == 1, 2).otherwise(3)
    return g.withColumn("level", level.cast("int")).drop("_gid")


def highlights(risk: DataFrame) -> DataFrame:
    """Most urgent SKU, horizon units, mean risks."""
    return risk.agg(
        F.min_by("sku_id", F.struct(-F.col("priority_score"), F.col("sku_id"))).alias("most_urgent_sku"),
        F.sum("forecast_8w_units").alias("forecast_8w_units"),
        F.avg("stockout_risk").alias("avg_stockout_risk"),
        F.avg("overstock_risk").alias("avg_overstock_risk"),
    )


def category_impact(risk: DataFrame) -> DataFrame:
    """D8."""
    return (risk.groupBy("category")
                .agg(F.sum("sales_at_risk_rupees").alias("sales_at_risk"),
                     F.sum("locked_capital_rupees").alias("locked_capital"),
                     F.countDistinct("sku_id").alias("skus"))
                .orderBy(F.desc("sales_at_risk"), "category"))


def weekly_trend(weekly: DataFrame) -> DataFrame:
    """D9."""
    return (weekly.groupBy("week_start")
                  .agg(F.sum("units_sold").alias("units_sold"), F.sum("revenue").alias("revenue"))
                  .orderBy("week_start"))


def top_actions(risk: DataFrame, n: int = 12) -> DataFrame:
    """D10 (+P8/D31 formats): the top-n action list."""
    return (risk.orderBy(F.desc("priority_score"), "sku_id").limit(n)
                .select("sku_id", "sku_name", "category", "recommended_action", "reason", "recommended_order_qty",
                        "markdown_candidate_units", fmt.money("sales_at_risk_rupees").alias("sales_at_risk"),
                        fmt.money("locked_capital_rupees").alias("locked_capital"), "priority_score"))


def sku_series(weekly: DataFrame, forecasts: DataFrame, history_weeks: int = 70) -> DataFrame:
    """Per SKU, the last ``history_weeks`` actual weeks then the horizon rows."""
    recent = Window.partitionBy("sku_id").orderBy(F.desc("week_start"))
    hist = (weekly.withColumn("_r", F.row_number().over(recent)).where(F.col("_r") <= history_weeks)
                  .select("sku_id", "week_start", F.lit("actual").alias("series"),
                          F.col("units_sold").alias("units")))
    fut = forecasts.select("sku_id", "week_start", F.lit("forecast").alias("series"),
                           F.col("forecast_units").alias("units"))
    return hist.unionByName(fut)


def top_skus(risk: DataFrame, n: int) -> DataFrame:
    return risk.orderBy(F.desc("priority_score"), "sku_id").limit(n).select("sku_id")


def sku_compare(risk: DataFrame, forecasts: DataFrame, n: int = 6) -> DataFrame:
    """Forecast rows of the top-n SKUs by priority (semi join)."""
    return (forecasts.join(top_skus(risk, n), "sku_id", "left_semi")
                     .select("sku_id", "week_start", "horizon_week", "forecast_units"))


def backtest_trend(backtest: DataFrame) -> DataFrame:
    """Mean point error per week, model and baseline."""
    d = F.greatest(F.col("units_sold"), F.lit(1.0))
    return (backtest.groupBy("week_start")
                    .agg(F.avg(F.col("abs_error_model") / d).alias("model"),
                         F.avg(F.col("abs_error_baseline") / d).alias("baseline"))
                    .orderBy("week_start"))


def priority_pivot(risk: DataFrame) -> DataFrame:
    """Category x action mean priority, 0 where empty (explicit pivot values)."""
    return risk.groupBy("category").pivot("recommended_action", ACTIONS).avg("priority_score").fillna(0.0)


# ---------------------------------------------------------------- D15-D16
def _z_for(service_level: Column) -> Column:
    pairs = []
    for k, v in Z_BY_SERVICE_LEVEL.items():
        pairs += [F.lit(k), F.lit(v)]
    z_map = F.create_map(*pairs)
    return F.coalesce(F.element_at(z_map, F.round(service_level, 2)), F.lit(DEFAULT_Z))


# A scenario's fields and what a missing one means (discount %, ad %, lead-time days, service level).
SCENARIO_FIELDS = {"discount_change": 0.0, "ad_change": 0.0, "lead_time_change": 0.0, "service_level": 0.92}
SCENARIOS_A_BLOCK, BROADCAST_SCENARIOS = 1_000, 200_000


def scenario_table(spark: SparkSession, scenarios: list[dict]) -> DataFrame:
    """Scenarios given as dictionaries, as the table the sweep takes."""
    rows = [(int(s.get("scenario_id", i)), *[float(s.get(f, d)) for f, d in SCENARIO_FIELDS.items()]) for i, s in enumerate(scenarios)]
    return spark.createDataFrame(rows, "scenario_id int, " + ", ".join(f"{f} double" for f in SCENARIO_FIELDS))


def each_scenario(df: DataFrame, scenarios: DataFrame | list[dict], broadcast_scenarios: int = BROADCAST_SCENARIOS) -> DataFrame:
    """Every row of ``df`` under every scenario, as the struct ``sc``.

    Scenarios become blocks of bounded arrays.  A row meets each block once,
    by a join on the block's number, and the array is unfolded there, so no
    SKU or scenario is a hot key: up to ``broadcast_scenarios`` (they are
    counted) the blocks go to every task; beyond, each block has a copy for
    each of several salts, and rows spread over them.  Null fields take their
    defaults, repeated ids stay.
    """
    if isinstance(scenarios, list):
        scenarios = scenario_table(df.sparkSession, scenarios)
    fields = F.struct(F.col("scenario_id"), *[F.coalesce(F.col(f).cast("double"), F.lit(d)).alias(f) for f, d in SCENARIO_FIELDS.items()])
    n = scenarios.count()
    blocks = max(1, -(-n // SCENARIOS_A_BLOCK))
    few = n <= broadcast_scenarios
    salts = 1 if few else int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    folded = (scenarios.select(F.pmod(F.xxhash64("scenario_id", *SCENARIO_FIELDS), F.lit(blocks)).cast("int").alias("_block"), fields.alias("s"))
              .groupBy("_block").agg(F.collect_list("s").alias("_scenarios"))
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    rows = df.withColumns({"_block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int"))
    met = rows.join(F.broadcast(folded) if few else folded, ["_block", "_salt"])
    return met.select(*df.columns, F.explode("_scenarios").alias("sc"))


def recent_demand_std(weekly: DataFrame, weeks: int = HISTORY_WEEKS_FOR_STD) -> DataFrame:
    """Sample std of weekly units over each SKU's last ``weeks`` weeks."""
    recent = Window.partitionBy("sku_id").orderBy(F.desc("week_start"))
    return (weekly.withColumn("_r", F.row_number().over(recent)).where(F.col("_r") <= weeks)
                  .groupBy("sku_id").agg(F.stddev_samp("units_sold").alias("demand_std")))


def scenario_sweep(risk: DataFrame, weekly: DataFrame, scenarios: DataFrame | list[dict]) -> DataFrame:
    """The what-if simulator applied to every SKU under every scenario of a table (or list)."""
    df = each_scenario(risk.join(recent_demand_std(weekly), "sku_id", "left")
                           .select("sku_id", "forecast_8w_units", "lead_time_days", "available_units", "sales_at_risk_rupees",
                                   "recommended_action", F.coalesce("demand_std", F.lit(0.0)).alias("demand_std")), scenarios)
    sc = lambda c: F.col("sc")[c]
    du = 1 + F.greatest(sc("discount_change"), F.lit(float(DISCOUNT_FLOOR_PCT))) * DISCOUNT_UPLIFT_PER_PCT
    au = 1 + sc("ad_change") * AD_UPLIFT_PER_PCT
    df = df.withColumns({
        "scenario_id": sc("scenario_id"),
        "simulated_forecast": F.greatest(F.lit(0.0), F.col("forecast_8w_units") * du * au),
        "sim_lead_time_days": F.greatest(F.lit(1.0), F.col("lead_time_days") + sc("lead_time_change")),
        "z": _z_for(sc("service_level")),
    })
    df = df.withColumns({
        "leadtime_demand": F.col("simulated_forecast") * (F.col("sim_lead_time_days") / LEAD_HORIZON_DAYS),
        "safety_stock": F.col("z") * F.col("demand_std") * F.sqrt(F.col("sim_lead_time_days") / 7),
    })
    df = df.withColumn("suggested_order", F.greatest(F.lit(0), F.ceil(
        F.col("leadtime_demand") + F.col("safety_stock") - F.col("available_units"))).cast("bigint"))
    value_per_unit = F.when(F.col("forecast_8w_units") != 0,
                            F.col("sales_at_risk_rupees") / F.greatest(F.col("forecast_8w_units"), F.lit(1.0)))
    note = (F.when(F.col("suggested_order") > 0, "order")
             .when(F.col("available_units") > F.col("simulated_forecast") * MARKDOWN_COVER, "markdown")
             .otherwise("balanced"))
    return df.select("scenario_id", "sku_id", "simulated_forecast", "sim_lead_time_days", "leadtime_demand",
                     "demand_std", "z", "safety_stock", "suggested_order",
                     (F.col("simulated_forecast") * F.coalesce(value_per_unit, F.lit(0.0))).alias("simulated_sales"),
                     note.alias("decision_note"))


def scenario_curve(forecasts: DataFrame, scenarios: DataFrame | list[dict]) -> DataFrame:
    """Base vs simulated weekly demand for every scenario."""
    df = each_scenario(forecasts.select("sku_id", "week_start", "forecast_units"), scenarios)
    du = 1 + F.greatest(F.col("sc")["discount_change"], F.lit(float(DISCOUNT_FLOOR_PCT))) * DISCOUNT_UPLIFT_PER_PCT
    au = 1 + F.col("sc")["ad_change"] * AD_UPLIFT_PER_PCT
    return df.select(F.col("sc")["scenario_id"].alias("scenario_id"), "sku_id", "week_start", "forecast_units",
                     (F.col("forecast_units") * du * au).alias("simulated_units"))


# ---------------------------------------------------------------- D17-D23
def segment_view(customers: DataFrame) -> DataFrame:
    """Customers, revenue, units, mean churn and return rate per segment."""
    return (customers.groupBy("segment")
                     .agg(F.countDistinct("customer_id").alias("customers"), F.sum("monetary").alias("revenue"),
                          F.sum("units").alias("units"), F.avg("churn_risk").alias("avg_churn_risk"),
                          F.avg("return_rate").alias("avg_return_rate"))
                     .orderBy(F.desc("revenue")))


def customer_kpis(customers: DataFrame) -> DataFrame:
    """D17/D33 KPI row."""
    return customers.agg(
        F.countDistinct("customer_id").alias("customers"),
        F.coalesce(F.sum("monetary"), F.lit(0.0)).alias("customer_revenue"),
        F.count_if(F.col("churn_risk") > HIGH_CHURN).alias("high_churn_customers"),
        F.avg("return_rate").alias("avg_return_rate"),
        F.avg("churn_risk").alias("avg_churn_risk"),
    )


def segment_drill(customers: DataFrame, segment: str) -> DataFrame:
    """One segment, highest churn first, with its count and revenue."""
    seg = customers.where(F.col("segment") == segment)
    # whole cents: the total does not depend on the order of the rows
    cents = F.sum(F.round(F.col("monetary") * 100).cast("bigint"))
    total = seg.select(F.struct(F.count(F.lit(1)).alias("n"), (cents / 100).alias("revenue"))).scalar()
    return (seg.withColumns({"segment_customers": total["n"], "segment_revenue": total["revenue"]})
               .orderBy(F.desc("churn_risk"), "customer_id"))


def histogram(df: DataFrame, value: str, bins: int, by: list[str] | None = None) -> DataFrame:
    """Equal-width bins between min and max; the maximum joins the last bin."""
    b = df.select(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    lo, hi = b["lo"], b["hi"]
    x = F.col(value)
    raw = F.floor((x - lo) * bins / (hi - lo)).cast("int") + 1
    bucket = F.when(hi == lo, F.lit(1)).otherwise(F.least(raw, F.lit(bins)))
    keys = list(by or [])
    return (df.where(x.isNotNull()).withColumn("bucket", bucket.cast("int"))
              .groupBy(*keys, "bucket")
              .agg(F.count(F.lit(1)).alias("count"))
              .withColumns({"bin_low": lo + (F.col("bucket") - 1) * (hi - lo) / bins,
                            "bin_high": lo + F.col("bucket") * (hi - lo) / bins})
              .orderBy(*keys, "bucket"))


def retention_queue(customers: DataFrame, n: int = 80) -> DataFrame:
    """D21."""
    return customers.orderBy(F.desc("churn_risk"), F.desc("monetary"), "customer_id").limit(n)


def data_health(df: DataFrame) -> DataFrame:
    """Rows, columns, missing cells and duplicate rows (by digests) in one aggregate."""
    missing = reduce(lambda a, b: a + b, [F.sum(F.col(c).isNull().cast("bigint")) for c in df.columns])
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"),
                  F.coalesce(missing, F.lit(0)).alias("missing_cells"),
                  (F.count(F.lit(1)) - distinct_count(df)).alias("duplicate_rows"))


def missing_profile(df: DataFrame, top: int = 20) -> DataFrame:
    """Missing % per column (> 0), highest first, top 20; one aggregate then unpivot."""
    wide = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(c) for c in df.columns])
    long = wide.unpivot([], df.columns, "column", "missing_pct")
    return long.where(F.col("missing_pct") > 0).orderBy(F.desc("missing_pct"), "column").limit(top)


# ---------------------------------------------------------------- D24-D38
def meeting_summary(risk: DataFrame) -> DataFrame:
    """Category with the largest sales at risk and the top-priority SKU."""
    cat = (risk.groupBy("category").agg(F.sum("sales_at_risk_rupees").alias("s"))
               .orderBy(F.desc("s"), "category").limit(1).select("category"))
    top = risk.orderBy(F.desc("priority_score"), "sku_id").limit(1)
    return risk.agg(
        F.countDistinct("sku_id").alias("skus"),
        cat.select("category").scalar().alias("top_category"),
        top.select("sku_id").scalar().alias("top_sku"),
        top.select("sku_name").scalar().alias("top_sku_name"),
        top.select("recommended_action").scalar().alias("top_action"),
    )


def normalize_sku_id(text) -> Column:
    """``sku 007`` / ``SKU7`` in free text -> ``SKU0007`` (NULL when absent).

    ``format_string`` keeps ids past four digits whole (``lpad`` truncates).
    """
    digits = F.regexp_extract(F.lower(col(text)), r"sku\s*0*(\d+)", 1)
    return F.when(digits != "", F.format_string("SKU%04d", digits.cast("long")))


def sku_explanation(risk: DataFrame, question: str) -> DataFrame:
    """The risk row of the SKU named in a free-text question."""
    target = normalize_sku_id(F.lit(question))
    return risk.where(F.upper("sku_id") == F.upper(target))


def question_answers(risk: DataFrame, customers: DataFrame, metrics: DataFrame, sales: DataFrame) -> DataFrame:
    """The backing queries of the canned business questions, in one long table
    (question, rank, item, value)."""
    def rows(df, q, item, value, order):
        w = Window.orderBy(*order)
        return df.select(F.lit(q).alias("question"), F.row_number().over(w).cast("int").alias("rank"),
                         F.col(item).cast("string").alias("item"), F.col(value).cast("double").alias("value"))

    reorder = risk.where(F.col("recommended_action").ilike("%reorder%")).orderBy(
        F.desc("priority_score"), "sku_id").limit(8)
    over = risk.orderBy(F.desc("overstock_risk"), "sku_id").limit(8)
    seg = (customers.groupBy("segment").agg(F.avg("churn_risk").alias("avg_churn"))
                    .orderBy(F.desc("avg_churn"), "segment").limit(1))
    m = (metrics.where(F.col("scope") == "overall")
                .select(F.expr("stack(2, 'model_wape', model_wape, 'baseline_wape', baseline_wape) as (k, v)")))
    impact = risk.agg(F.sum("sales_at_risk_rupees").alias("a"), F.sum("locked_capital_rupees").alias("b"),
                      F.countDistinct(F.when(F.col("recommended_action").ilike("%reorder%"), F.col("sku_id")))
                      .cast("double").alias("c")) \
                 .select(F.expr("stack(3, 'total_sales_at_risk', a, 'total_locked_capital', b, "
                                "'reorder_skus', c) as (k, v)"))
    cat = (risk.groupBy("category").agg(F.sum("sales_at_risk_rupees").alias("s"))
               .orderBy(F.desc("s"), "category").limit(1))
    vcol = value_column(sales)
    reg = (sales.where(F.col("region").isNotNull()).groupBy("region").agg(F.sum(vcol).alias("s"))
                .orderBy(F.desc("s"), "region").limit(1))
    parts = [
        rows(reorder, "reorder", "sku_id", "stockout_risk", [F.desc("priority_score"), "sku_id"]),
        rows(over, "overstock", "sku_id", "overstock_risk", [F.desc("overstock_risk"), "sku_id"]),
        rows(seg, "churn", "segment", "avg_churn", [F.desc("avg_churn")]),
        rows(m, "accuracy", "k", "v", ["k"]),
        rows(impact, "impact", "k", "v", ["k"]),
        rows(cat, "category", "category", "s", [F.desc("s")]),
        rows(reg, "region", "region", "s", [F.desc("s")]),
    ]
    return reduce(DataFrame.unionByName, parts)


def category_drill(risk: DataFrame, category: str) -> DataFrame:
    """SKU rows of one category with the drill-down columns."""
    return risk.where(F.col("category") == category).select(
        "sku_id", "sku_name", "category", "subcategory", "recommended_action", "stockout_risk", "overstock_risk",
        "forecast_8w_units", "available_units", "recommended_order_qty", "sales_at_risk_rupees", "locked_capital_rupees",
        "priority_score", "reason")


def value_column(df: DataFrame) -> Column:
    """Sales value column: the first present of the known names, else
    units x price, else units."""
    for c in VALUE_COLUMNS:
        if c in df.columns:
            return F.col(c)
    if "unit_price" in df.columns:
        for u in ("units_sold", "units"):
            if u in df.columns:
                return F.col(u) * F.col("unit_price")
    if "units_sold" in df.columns:
        return F.col("units_sold")
    raise ValueError("no sales value column")


def date_column(df: DataFrame) -> str | None:
    """The first present of the known date column names."""
    return next((c for c in DATE_COLUMNS if c in df.columns), None)


def region_sales(sales: DataFrame, coordinates: list[tuple] = REGION_COORDINATES) -> DataFrame:
    """Sales value per region with its coordinates (null for a region without any)."""
    coords = sales.sparkSession.createDataFrame(coordinates, "region string, lat double, lon double")
    g = sales.where(F.col("region").isNotNull()).groupBy("region").agg(F.sum(value_column(sales)).alias("sales_value"))
    return g.join(coords, "region", "left")


def group_sum(df: DataFrame, group: str, value: Column, name: str = "sales_value") -> DataFrame:
    """Generic sum by group, largest first (NULL group keys dropped)."""
    return (df.where(F.col(group).isNotNull()).groupBy(group).agg(F.sum(value).alias(name))
              .orderBy(F.desc(name), group))


def sales_trend(sales: DataFrame) -> DataFrame:
    """Sales value by day."""
    d = date_column(sales)
    return sales.where(F.col(d).isNotNull()).groupBy(F.col(d).alias("date")).agg(
        F.sum(value_column(sales)).alias("sales_value")).orderBy("date")


def sales_calendar(sales: DataFrame) -> DataFrame:
    """Sales value by month (yyyy-MM), by quarter and by day name, in one
    grouping-sets pass."""
    d = F.col(date_column(sales))
    df = sales.where(d.isNotNull()).select(
        F.date_format(d, "yyyy-MM").alias("month"), F.quarter(d).cast("string").alias("quarter"),
        F.date_format(d, "EEEE").alias("day_name"), value_column(sales).alias("_v"))
    g = df.groupingSets([["month"], ["quarter"], ["day_name"]], "month", "quarter", "day_name").agg(
        F.grouping_id().alias("_gid"), F.sum("_v").alias("sales_value"))
    grain = F.when(F.col("_gid") == 3, "month").when(F.col("_gid") == 5, "quarter").otherwise("day_name")
    return g.select(grain.alias("grain"), F.coalesce("month", "quarter", "day_name").alias("bucket"), "sales_value")


def executive_page(sales: DataFrame, risk: DataFrame) -> DataFrame:
    """Total sales, impact, reorder and markdown SKU counts (case-insensitive patterns)."""
    total = sales.select(F.coalesce(F.sum(value_column(sales)), F.lit(0.0))).scalar()
    a = F.col("recommended_action")
    return risk.agg(
        total.alias("total_sales"),
        F.coalesce(F.sum("sales_at_risk_rupees"), F.lit(0.0)).alias("sales_at_risk"),
        F.coalesce(F.sum("locked_capital_rupees"), F.lit(0.0)).alias("locked_capital"),
        F.countDistinct(F.when(a.rlike("(?i)reorder"), F.col("sku_id"))).alias("reorder_skus"),
        F.countDistinct(F.when(a.rlike("(?i)markdown|clear"), F.col("sku_id"))).alias("markdown_skus"),
    )


def executive_categories(risk: DataFrame) -> DataFrame:
    """Category summary with mean stockout risk."""
    return (risk.groupBy("category")
                .agg(F.sum("sales_at_risk_rupees").alias("sales_at_risk"),
                     F.sum("locked_capital_rupees").alias("locked_capital"),
                     F.avg("stockout_risk").alias("avg_stockout"), F.countDistinct("sku_id").alias("sku_count"))
                .orderBy(F.desc("sales_at_risk"), "category"))


# The behaviour measures, any two of which make a chart.
BEHAVIOUR = ["recency_days", "frequency", "monetary", "churn_risk", "return_rate"]


def customer_pairs(customers: DataFrame, measures: list[str] = BEHAVIOUR) -> DataFrame:
    """Every customer's point in the chart of every two behaviour measures, by segment."""
    pairs = [F.struct(F.lit(f"{a} / {b}").alias("pair"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"))
             for a, b in combinations(measures, 2)]
    return customers.select("customer_id", "segment", F.explode(F.array(*pairs)).alias("p")).select(
        "p.pair", "customer_id", "segment", "p.x", "p.y")


def revenue_page(sales: DataFrame) -> DataFrame:
    """Total revenue, mean discount (a ratio; percents above 1 are scaled), returns."""
    avg_disc = F.avg("discount_pct")
    return sales.agg(F.coalesce(F.sum(value_column(sales)), F.lit(0.0)).alias("total_revenue"),
                     F.when(avg_disc > 1, avg_disc / 100).otherwise(avg_disc).alias("avg_discount"),
                     F.coalesce(F.sum("return_units"), F.lit(0.0)).alias("returned_units"))


def locked_capital_top(risk: DataFrame, n: int = 15) -> DataFrame:
    """Top SKUs by locked capital."""
    return (risk.orderBy(F.desc("locked_capital_rupees"), "sku_id").limit(n)
                .select("sku_id", "sku_name", "category", "locked_capital_rupees", "recommended_action"))


# The columns of the inventory page.
INVENTORY_PAGE_COLUMNS = ["sku_id", "sku_name", "category", "available_units", "forecast_8w_units", "stockout_risk",
                          "overstock_risk", "sales_at_risk_rupees", "locked_capital_rupees", "recommended_order_qty",
                          "recommended_action", "reason"]


def inventory_page(risk: DataFrame) -> DataFrame:
    """Mean risks and SKU count."""
    return risk.agg(F.avg("stockout_risk").alias("avg_stockout_risk"),
                    F.avg("overstock_risk").alias("avg_overstock_risk"),
                    F.countDistinct("sku_id").alias("sku_count"))


def orders_page(sales: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct orders and customers, units (exact or HyperLogLog counts)."""
    units = F.coalesce(F.sum("units_sold"), F.lit(0.0)).alias("units_sold")
    has_orders = "order_id" in sales.columns
    if approx:
        orders = F.approx_count_distinct("order_id") if has_orders else F.count(F.lit(1))
        return sales.agg(orders.alias("orders"), F.approx_count_distinct("customer_id").alias("customers"), units)
    # one pre-aggregation a key, instead of expanding every line for two distinct counts
    count = lambda c: sales.where(F.col(c).isNotNull()).groupBy(c).agg(F.lit(1).alias("_")).select(F.count(F.lit(1))).scalar()
    orders = count("order_id") if has_orders else F.count(F.lit(1))
    return sales.agg(orders.alias("orders"), count("customer_id").alias("customers"), units)


# The columns of the order listing.
ORDER_LISTING = ["date", "order_id", "customer_id", "sku_id", "sales_channel", "region", "units_sold", "unit_price",
                 "discount_pct", "revenue"]


def order_listing(sales: DataFrame, n: int = 100) -> DataFrame:
    """The first ``n`` order lines by date (those of the columns that exist)."""
    shown = [c for c in ORDER_LISTING if c in sales.columns]
    return sales.select(*shown).orderBy(*shown).limit(n)


def top_list(risk: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` SKUs of highest priority."""
    return risk.orderBy(F.desc("priority_score"), "sku_id").limit(n)


def found_or_raise(df: DataFrame, sku_id: str) -> DataFrame:
    """The rows of one SKU (a pushed-down key filter); reading an unknown id is an error, raised inside the plan."""
    asked = df.sparkSession.createDataFrame([(sku_id,)], "_asked string")
    rows = df.where(F.col("sku_id") == sku_id)
    unknown = F.raise_error(F.concat(F.lit("no such SKU in the risk table: "), F.col("_asked"))).cast("string")
    key = F.coalesce(F.col("sku_id"), unknown).alias("sku_id")
    return asked.join(rows, F.col("_asked") == F.col("sku_id"), "left").select(*[key if c == "sku_id" else F.col(c) for c in df.columns])


def any_column_search(df: DataFrame, text: str) -> DataFrame:
    """Rows where any column, as text, contains ``text`` (case-insensitive)."""
    pattern = "%" + text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%"
    hit = reduce(lambda a, b: a | b, [F.coalesce(F.col(c).cast("string").ilike(pattern), F.lit(False))
                                      for c in df.columns])
    return df.where(hit)


# ---------------------------------------------------------------- A1-A6, P
def sku_list(risk: DataFrame, limit: int = 50) -> DataFrame:
    """A2: the first ``limit`` SKUs in priority order."""
    return (risk.orderBy(F.desc("priority_score"), "sku_id").limit(limit)
                .select("sku_id", "sku_name", "category", "recommended_action", "priority_score"))


def sku_detail(risk: DataFrame, forecasts: DataFrame, sku_ids: DataFrame) -> DataFrame:
    """A3: risk row plus the ordered forecast rows (as an array of structs) per requested SKU."""
    fc = (forecasts.join(sku_ids, "sku_id", "left_semi").groupBy("sku_id")
                   .agg(F.sort_array(F.collect_list(F.struct("horizon_week", "week_start", "forecast_units",
                                                             "forecast_lower_80", "forecast_upper_80")))
                        .alias("forecast")))
    return risk.join(sku_ids, "sku_id", "left_semi").join(fc, "sku_id", "left")


# The columns of a score.
SCORE_COLUMNS = ["sku_id", "category", "forecast_8w_units", "stockout_risk", "overstock_risk", "recommended_action",
                 "priority_score", "sales_at_risk_rupees", "locked_capital_rupees", "reason"]


def score_sku(risk: DataFrame, sku_id: str) -> DataFrame:
    """A4: the 10-column score of one SKU (pushed-down key filter)."""
    return found_or_raise(risk.select(*SCORE_COLUMNS), sku_id)


def one_sku(risk: DataFrame, forecasts: DataFrame, sku_id: str) -> DataFrame:
    """A3 for one id: its detail row; reading an unknown id is an error."""
    ids = risk.where(F.col("sku_id") == sku_id).select("sku_id")
    return found_or_raise(sku_detail(risk, forecasts, ids), sku_id)


def batch_score(risk: DataFrame, sku_ids: DataFrame) -> DataFrame:
    """A5: risk rows of the requested ids; unknown ids drop out (left-semi join)."""
    return risk.join(sku_ids.select("sku_id").distinct(), "sku_id", "left_semi")


def portfolio_summary(risk: DataFrame) -> DataFrame:
    """Impact totals, action counts as a map, distinct SKUs."""
    counts = risk.groupBy("recommended_action").agg(F.count(F.lit(1)).alias("n"))
    action_map = counts.select(F.map_from_entries(F.collect_list(F.struct("recommended_action", "n")))).scalar()
    return risk.agg(F.coalesce(F.sum("sales_at_risk_rupees"), F.lit(0.0)).alias("sales_at_risk_rupees"),
                    F.coalesce(F.sum("locked_capital_rupees"), F.lit(0.0)).alias("locked_capital_rupees"),
                    action_map.alias("action_counts"),
                    F.countDistinct("sku_id").alias("sku_count"))


def output_ready(spark, paths: dict[str, str]) -> DataFrame:
    """A1: whether each output table is whole, what it is otherwise (``store.state``), and its rows by the manifest."""
    status = []
    for name, path in paths.items():
        found, manifest = store.state(spark, path)
        status.append((name, found == "ready", found, manifest["rows"] if manifest else None))
    return spark.createDataFrame(status, "table string, ready boolean, state string, rows long")


def data_profile(weekly: DataFrame, customers: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Rows, distinct SKUs / categories / customers, max horizon."""
    return weekly.agg(
        F.count(F.lit(1)).alias("weekly_rows"), F.countDistinct("sku_id").alias("skus"),
        F.countDistinct("category").alias("categories"),
        customers.select(F.countDistinct("customer_id")).scalar().alias("customers"),
        forecasts.select(F.max("horizon_week")).scalar().alias("max_horizon"))


def executive_summary(metrics: DataFrame, risk: DataFrame, customers: DataFrame) -> DataFrame:
    """The one-row executive summary (model quality, impact, counts)."""
    m = metrics.where(F.col("scope") == "overall").select(
        F.struct(F.first("model_wape").alias("m"), F.first("baseline_wape").alias("b"))).scalar()
    mw, bw = m["m"], m["b"]
    a = F.col("recommended_action")
    return risk.agg(
        mw.alias("model_wape"), bw.alias("baseline_wape"),
        (F.lit(1.0) - mw / F.greatest(bw, F.lit(1e-9))).alias("wape_improvement"),
        F.coalesce(F.sum("sales_at_risk_rupees"), F.lit(0.0)).alias("sales_at_risk_rupees"),
        F.coalesce(F.sum("locked_capital_rupees"), F.lit(0.0)).alias("locked_capital_rupees"),
        F.count_if(a == ACTION_REORDER).alias("reorder_now_skus"),
        F.count_if(a == ACTION_MARKDOWN).alias("markdown_clear_skus"),
        customers.select(F.countDistinct("customer_id")).scalar().alias("customers_scored"),
    )
