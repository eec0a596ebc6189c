import datetime as dt

from pyspark.sql import functions as F

from stockpulse.functions import fmt
from stockpulse.operators import views as V

RISK_SCHEMA = ("sku_id string, sku_name string, category string, subcategory string, recommended_action string, "
               "priority_score double, stockout_risk double, overstock_risk double, sales_at_risk_rupees double, "
               "locked_capital_rupees double, forecast_8w_units double, reason string")


def _risk(spark):
    data = [("SKU0001", "Desk Lamp", "Lighting", "Lamps", "Reorder now", 80.0, 0.9, 0.0, 2.5e7, 0.0, 100.0, "r"),
            ("SKU0002", "Sofa", "Furniture", "Sofas", "Markdown / clear", 40.0, 0.1, 0.8, 0.0, 2e5, 5.0, "m"),
            ("SKU0003", "Bed Lamp", "Lighting", "Lamps", "Healthy", 10.0, 0.2, 0.1, 500.0, 10.0, 20.0, "h"),
            ("SKU0004", "Pillow", "Bedding", "Pillows", "Reorder now", 80.0, 0.7, 0.0, 100.0, 0.0, 30.0, "r")]
    return spark.createDataFrame(data, RISK_SCHEMA)


def test_filter_portfolio(spark):
    r = _risk(spark)
    assert V.filter_portfolio(r, categories=["Lighting"], search="LAMP").count() == 2
    assert V.filter_portfolio(r, priority_floor=50, stockout_floor=0.8).select("sku_id").first()[0] == "SKU0001"
    assert V.filter_portfolio(r, search="^sku000[12]$", regex=True).count() == 2


def test_rollup_levels_and_pivot(spark):
    roll = V.risk_rollup(_risk(spark)).collect()
    top = [x for x in roll if x["level"] == 0][0]
    assert top["priority_total"] == 210.0 and top["skus"] == 4
    piv = {x["category"]: x for x in V.priority_pivot(_risk(spark)).collect()}
    assert piv["Lighting"]["Reorder now"] == 80.0 and piv["Lighting"]["Markdown / clear"] == 0.0


def test_highlights_tie_break(spark):
    h = V.highlights(_risk(spark)).first()
    assert h["most_urgent_sku"] == "SKU0001"      # tie at 80 -> smaller id


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in range(11)], "v double")
    h = {r["bucket"]: r["count"] for r in V.histogram(df, "v", 5).collect()}
    assert sum(h.values()) == 11 and max(h) == 5 and h[5] == 3


def test_formats_and_sku_normalisation(spark):
    df = spark.createDataFrame([(2.5e7,), (123456.0,), (999.4,), (None,)], "x double")
    got = [r[0] for r in df.select(fmt.money("x")).collect()]
    assert got == ["₹2.50 Cr", "₹1.23 L", "₹999", "₹0"]
    q = spark.createDataFrame([("why is sku 007 at risk?",), ("Sku12345",), ("no id",)], "q string")
    assert [r[0] for r in q.select(V.normalize_sku_id("q")).collect()] == ["SKU0007", "SKU12345", None]
    assert V.sku_explanation(_risk(spark), "tell me about sku 4").first()["sku_id"] == "SKU0004"


def test_any_column_search_and_health(spark):
    r = _risk(spark)
    assert V.any_column_search(r, "lamp").count() == 2
    assert V.any_column_search(r, "80.0").count() == 2       # numbers are searched as text too
    dup = r.unionByName(r.limit(1)).withColumn("reason", F.when(F.col("sku_id") == "SKU0003", None)
                                                .otherwise(F.col("reason")))
    h = V.data_health(dup).first()
    assert (h["rows"], h["missing_cells"], h["duplicate_rows"]) == (5, 1, 1)
    mp = V.missing_profile(dup).collect()
    assert [(x["column"], x["missing_pct"]) for x in mp] == [("reason", 20.0)]


def test_scenario_sweep_shapes(spark):
    risk = _risk(spark).withColumns({"lead_time_days": F.lit(14.0), "available_units": F.lit(10.0)})
    weekly = spark.createDataFrame([(s, dt.date(2024, 1, 1) + dt.timedelta(days=7 * i), float(i))
                                    for s in ("SKU0001", "SKU0002") for i in range(20)],
                                   "sku_id string, week_start date, units_sold double")
    sc = [{"scenario_id": 1, "service_level": 0.95}, {"scenario_id": 2, "discount_change": -50,
                                                      "service_level": 0.5}]
    out = V.scenario_sweep(risk, weekly, sc).collect()
    assert len(out) == 8
    z = {(r["sku_id"], r["scenario_id"]): r["z"] for r in out}
    assert z[("SKU0001", 1)] == 1.64 and z[("SKU0001", 2)] == 1.41
    s1 = [r for r in out if r["sku_id"] == "SKU0001" and r["scenario_id"] == 1][0]
    assert abs(s1["demand_std"] - float(__import__("numpy").std(range(8, 20), ddof=1))) < 1e-9


def test_unknown_sku_is_an_error_inside_the_plan(spark):
    import pytest

    known = V.found_or_raise(_risk(spark), "SKU0003")
    assert known.columns == _risk(spark).columns and [r["sku_name"] for r in known.collect()] == ["Bed Lamp"]
    unknown = V.found_or_raise(_risk(spark), "SKU9999")      # nothing runs before it is read
    with pytest.raises(Exception, match="SKU9999"):
        unknown.collect()
