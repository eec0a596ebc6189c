import datetime as dt

from pyspark.sql import functions as F

from stockpulse.operators import clean, features
from stockpulse.params import Params

from conftest import rows

D = dt.date


def _inputs(spark, weeks=6, inv=None, skus=("A", "B", "C")):
    sales = [(D(2024, 1, 1) + dt.timedelta(days=7 * w), s, float(w + 1), 10.0 * (w + 1), 10.0, True, "c1", f"o{w}{s}")
             for w in range(weeks) for s in skus[:2]]
    sales_df = spark.createDataFrame(sales, "date date, sku_id string, units_sold double, revenue double, "
                                            "unit_price double, promo_flag boolean, customer_id string, "
                                            "order_id string")
    sku_df = spark.createDataFrame([(s, "Cat", "Sub", D(2024, 1, 1), 5.0, 10.0, i) for i, s in enumerate(skus)],
                                   "sku_id string, category string, subcategory string, launch_date date, "
                                   "unit_cost double, list_price double, _ord long")
    cal = [(D(2024, 1, 1) + dt.timedelta(days=d), 1, 1, "Winter", False, "None") for d in range(7 * weeks)]
    cal_df = spark.createDataFrame(cal, "date date, week int, month int, season string, is_holiday boolean, "
                                        "promo_event string").withColumn("_ord", F.datediff("date", F.lit("2024-01-01")))
    inv_df = spark.createDataFrame(inv or [], "date date, sku_id string, on_hand_units double, "
                                              "on_order_units double, lead_time_days double, reorder_point double"
                                   ).withColumn("_ord", F.datediff("date", F.lit("2024-01-01")))
    return {"sales_daily": clean.clean_sales(sales_df), "sku_master": clean.clean_sku(sku_df),
            "calendar": clean.clean_calendar(cal_df), "inventory_snapshots": clean.clean_inventory(inv_df)}


def test_spine_and_fills(spark):
    # A: leading gap (first snapshot in week 2), inner gap, trailing gap; B: one snapshot; C: none, no sales
    inv = [(D(2024, 1, 9), "A", 5.0, 1.0, 7.0, 2.0), (D(2024, 1, 23), "A", 9.0, 1.0, 7.0, 2.0),
           (D(2024, 1, 10), "B", 4.0, 0.0, 3.0, 1.0)]
    cleaned = _inputs(spark, inv=inv)
    w = features.build_weekly_features(cleaned, Params(), materialize=False)
    assert w.count() == 3 * 6                                          # SKUs x weeks
    a = rows(w.where("sku_id = 'A'").orderBy("week_start"), "on_hand_units")
    assert [x[0] for x in a] == [5.0, 5.0, 5.0, 9.0, 9.0, 9.0]
    c = rows(w.where("sku_id = 'C'"), "on_hand_units", "warehouse_zone", "units_sold")
    assert all(x == (None, "Unknown", 0.0) for x in c)                 # per-SKU scope: no borrowing
    g = features.build_weekly_features(cleaned, Params(fill_scope="global"), materialize=False)
    cg = rows(g.where("sku_id = 'C'"), "on_hand_units")
    assert all(x[0] is None for x in cg)                               # C is last: nothing after it


def test_lags_rolling_guard_and_medians(spark):
    w = features.build_weekly_features(_inputs(spark, weeks=10), Params(), materialize=False)
    pre = features.pre_fill_features(_inputs(spark, weeks=10), Params())
    a = pre.where("sku_id = 'A'").orderBy("week_start").collect()
    assert [r["lag_1"] for r in a[:3]] == [None, 1.0, 2.0]
    assert [r["rolling_4_mean"] for r in a[:5]] == [None, None, None, None, 2.5]
    assert all(r["rolling_13_std"] is None for r in a)
    fa = w.where("sku_id = 'A'").orderBy("week_start").collect()
    # per-SKU median of lag_1 over weeks 2..10 = median(1..9) = 5
    assert fa[0]["lag_1"] == 5.0
    # no SKU has a 13-week std: global median of units (C contributes zeros)
    med = w.select(F.median("units_sold")).first()[0]
    assert fa[0]["rolling_13_std"] == med


def test_iso_week_fallback_at_year_edge(spark):
    df = spark.createDataFrame([(D(2024, 12, 30), None, None)], "week_start date, month int, week int")
    df = df.withColumns({"campaign_intensity": F.lit(None), "holiday_days": F.lit(None),
                         "weekend_days": F.lit(None)})
    r = features.calendar_fallbacks(df).first()
    assert (r["month"], r["week"], r["weekend_days"]) == (12, 1, 2.0)


def test_global_fill_scope_borrows_next_sku(spark):
    # A has no snapshot; B's first snapshot is 4.0 -> A borrows it only in "global" scope
    inv = [(D(2024, 1, 10), "B", 4.0, 0.0, 3.0, 1.0), (D(2024, 1, 17), "B", 6.0, 0.0, 3.0, 1.0)]
    cleaned = _inputs(spark, inv=inv)
    per_sku = features.build_weekly_features(cleaned, Params(), materialize=False)
    assert {r[0] for r in rows(per_sku.where("sku_id = 'A'"), "on_hand_units")} == {None}
    glob = features.build_weekly_features(cleaned, Params(fill_scope="global"), materialize=False)
    assert {r[0] for r in rows(glob.where("sku_id = 'A'"), "on_hand_units")} == {4.0}
    b = [r[0] for r in rows(glob.where("sku_id = 'B'").orderBy("week_start"), "on_hand_units")]
    assert b == [4.0, 4.0, 6.0, 6.0, 6.0, 6.0]
