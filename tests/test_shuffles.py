"""Digest-first duplicates, folded medians, scenario tables, sketches: results and plans."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from stockpulse.functions import dedup
from stockpulse.functions.columns import week_floor
from stockpulse.operators import clean, customers, features, sketches
from stockpulse.operators import views as V
from stockpulse.plans.context import Context
from stockpulse.session import materialize
from stockpulse.sources import adapters, io
from test_entry import plan_of


def some_rows(spark, n=400):
    rng = random.Random(6)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, 1.5, 2.5]), rng.choice([None, "a", "b"]), rng.randint(0, 30)) for _ in range(n)]
    return spark.createDataFrame(rows, "x string, y double, z string, k int").repartition(4)


def one_digest(columns):
    return F.lit(1).cast("long"), F.lit(2).cast("long")


def coarse_digest(columns):
    return F.col("k").cast("long") % 5, F.lit(0).cast("long")


@pytest.mark.parametrize("digest", [dedup.row_digest, one_digest, coarse_digest])
@pytest.mark.parametrize("few", [1_000_000, 0])
def test_distinct_rows_whatever_the_digest(spark, digest, few):
    df = some_rows(spark)
    want = sorted(map(str, df.dropDuplicates().collect()))
    got = dedup.distinct_rows(df, digest, few)
    assert got.columns == df.columns and sorted(map(str, got.collect())) == want
    assert spark.range(1).select(dedup.distinct_count(df, digest)).first()[0] == len(want)


def test_nulls_in_other_places_are_other_digests(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    high, low = dedup.row_digest(df.columns)
    assert df.select(high, low).distinct().count() == 2


def test_unique_rows_are_not_shuffled(spark, tmp_path):
    df = spark.range(3_000).select("id", F.lit("x" * 50).alias("wide"))
    df.write.parquet(str(tmp_path / "t"))
    plan = plan_of(dedup.distinct_rows(spark.read.parquet(str(tmp_path / "t"))))
    assert "BroadcastHashJoin" in plan and plan.count("LeftAnti") >= 1
    unique = plan[:plan.index("LeftSemi")]
    assert not re.search(r"Exchange hashpartitioning\(.*LeftAnti", unique.replace("\n", " ")) and plan.count("Exchange hashpartitioning") == 1


def test_clean_sales_is_the_same_by_digest(spark):
    ctx = Context(spark, SF0001)
    raw = materialize(ctx.dirty_sales)
    assert sorted(map(str, clean.clean_sales(raw, by_digest=True).collect())) == sorted(map(str, clean.clean_sales(raw).collect()))


def test_medians_are_folded_once(spark):
    rng = random.Random(2)
    rows = [(f"s{i % 5}", dt.date(2024, 1, 1) + dt.timedelta(weeks=i // 5), rng.choice([None, 1.0, 4.0, 9.0]), None if i % 5 == 3 else rng.random()) for i in range(205)]
    df = materialize(spark.createDataFrame(rows, "sku_id string, week_start date, a double, b double"))
    got = features.median_fill(df, ["a", "b"], F.lit(-1.0))
    plan = plan_of(got)
    assert "median" not in plan and "percentile" not in plan and plan.count("Sort [") == 0 and plan.count("Window [") == 0
    assert plan.count("Exchange hashpartitioning") <= 2 and "ShuffledHashJoin" in plan
    want = {}
    for s in {r[0] for r in rows}:
        for j, c in ((2, "a"), (3, "b")):
            v = sorted(r[j] for r in rows if r[0] == s and r[j] is not None)
            want[s, c] = (v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2 if v else -1.0
    old = {(r[0], r[1]): r for r in rows}
    for r in got.collect():
        for j, c in ((2, "a"), (3, "b")):
            known = old[r["sku_id"], r["week_start"]][j]
            assert r[c] == (known if known is not None else want[r["sku_id"], c])


@pytest.mark.parametrize("few", [200_000, 0])
def test_every_row_meets_every_scenario(spark, monkeypatch, few):
    monkeypatch.setattr(V, "SCENARIOS_A_BLOCK", 7)
    rows = spark.range(23).select(F.col("id").alias("sku_id"))
    table = spark.createDataFrame([(i % 40, float(i), None, 1.0, None) for i in range(50)],
                                  "scenario_id int, discount_change double, ad_change double, lead_time_change double, service_level double")
    got = V.each_scenario(rows, table, few).select("sku_id", "sc.*").collect()
    assert len(got) == 23 * 50 and {(r["sku_id"], r["discount_change"]) for r in got} == {(s, float(i)) for s in range(23) for i in range(50)}
    assert {(r["ad_change"], r["service_level"]) for r in got} == {(0.0, 0.92)}
    assert V.each_scenario(rows, table.limit(0), few).count() == 0


def test_sketches_merge_without_the_lines(spark):
    rows = [(f"s{i % 3}", f"r{i % 2}", dt.date(2024, 1, 1) + dt.timedelta(days=i % 60), f"c{i % 900}", i) for i in range(6_000)]
    sales = spark.createDataFrame(rows, "sku_id string, region string, date date, customer_id string, order_id long")
    kept = materialize(sketches.weekly_sketches(sales))
    whole = sketches.roll_up(kept).first()
    assert abs(whole["customers"] - 900) <= 900 * sketches.ERROR and abs(whole["orders"] - 6_000) <= 6_000 * sketches.ERROR
    by = {r["sku_id"]: r["orders"] for r in sketches.roll_up(kept, "sku_id").collect()}
    assert len(by) == 3 and all(abs(n - 2_000) <= 2_000 * sketches.ERROR for n in by.values())


def test_tasks_of_the_order_join_follow_the_lines(spark, monkeypatch):
    tables = adapters.read_tables(spark, SF0001)
    whole = clean.clean_sales(adapters.sales_daily(tables))
    monkeypatch.setattr(adapters, "LINES_PER_TASK", 500)
    dealt = clean.clean_sales(adapters.sales_daily(tables))
    lines = [r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(lines) >= 10 and max(lines) <= 1_500
    assert dealt.exceptAll(whole).count() == 0 and whole.exceptAll(dealt).count() == 0


def test_customers_are_made_in_tasks_that_follow_the_lines(spark, monkeypatch):
    i = F.col("id")
    tables = {
        "region": spark.createDataFrame([(0, "NORTH"), (1, "SOUTH")], "r_regionkey int, r_name string"),
        "nation": spark.createDataFrame([(0, 0), (1, 1), (2, 0)], "n_nationkey int, n_regionkey int"),
        "customer": spark.range(60).select(i.alias("c_custkey"), (i % 3).cast("int").alias("c_nationkey")),
        "part": spark.range(7).select(i.alias("p_partkey"), (i % 2).cast("string").alias("p_brand"), F.lit("T").alias("p_type")),
        "orders": spark.range(1_500).select(i.alias("o_orderkey"), (i % 50).alias("o_custkey"), F.lit("1-URGENT").alias("o_orderpriority")),
        "lineitem": spark.range(6_000).select((i % 1_600).alias("l_orderkey"), F.when(i % 9 > 0, i % 7).alias("l_partkey"), (1 + i % 4).cast("double").alias("l_quantity"),
                                              (10 + i % 90).cast("double").alias("l_extendedprice"), ((i % 5) / 100).alias("l_discount"), F.when(i % 6 > 0, "N").otherwise("R").alias("l_returnflag"),
                                              F.lit("O").alias("l_linestatus"), F.timestamp_seconds(820_454_400 + i % 400 * 86_400).alias("l_shipdate"))}
    tables["lineitem"] = tables["lineitem"].unionAll(tables["lineitem"].where("l_orderkey % 10 = 0"))

    def segments():
        sales = clean.clean_sales(adapters.sales_daily(tables))
        found = customers.customer_segments(sales)
        found = found.select(*[F.round(c, 9).alias(c) if t == "double" else c for c, t in found.dtypes])
        return sorted(map(str, found.collect())), plan_of(customers.rfm_base(sales, materialize=False))

    whole, _ = segments()
    monkeypatch.setattr(adapters, "LINES_PER_TASK", 300)
    dealt, plan = segments()
    tasks = adapters.order_tasks(tables["lineitem"])
    assert tasks > spark.sparkContext.defaultParallelism
    assert re.search(rf"hashpartitioning\(l_orderkey#\d+L, {tasks}\), REPARTITION_BY_NUM", plan)
    assert len(dealt) == 50 and dealt == whole


def test_customers_are_counted_apart_from_the_measures(spark):
    def row(sku, day, who, units, price, discount, promo=True):
        return (sku, dt.date(2024, 1, day), who, units, units * 1.25, price, discount, promo, 0.0, 0.0, 1.0, False)

    data = [row("a", 1, "x", 2.0, 1.0, 0.1), row("a", 2, "x", 3.0, None, 0.2), row("a", 3, None, 4.0, 2.0, None, None), row("a", 8, "y", 1.0, None, None),
            row("b", 1, "x", 1.0, 3.0, 0.0, False), row("b", 1, "y", 1.0, 3.0, 0.0), row(None, 1, None, 5.0, 1.0, 0.5), row("b", 1, "y", 1.0, 3.0, 0.0)]
    sales = spark.createDataFrame(data, "sku_id string, date date, customer_id string, units_sold double, revenue double, unit_price double, discount_pct double, "
                                        "promo_flag boolean, ad_spend double, page_views double, return_units double, stockout_flag boolean").repartition(3)
    weekly = features.weekly_sales(sales, with_date_bounds=True)
    plain = sales.groupBy("sku_id", week_floor("date").alias("week_start")).agg(
        F.min("date"), F.max("date"), F.sum("units_sold"), F.sum(F.round(F.col("revenue") * 100).cast("bigint")) / 100, F.avg("unit_price"), F.sum(F.col("promo_flag").cast("int")),
        F.avg("discount_pct"), F.sum("ad_spend"), F.sum("page_views"), F.sum("return_units"), F.sum(F.col("stockout_flag").cast("int")), F.countDistinct("customer_id"))
    key = lambda r: (r["sku_id"] or "", r["week_start"])
    for got, want in zip(sorted(weekly.collect(), key=key), sorted(plain.collect(), key=key), strict=True):
        assert list(got) == pytest.approx(list(want))
    assert [f.dataType for f in weekly.schema] == [f.dataType for f in plain.schema]
    assert re.search(r"hashpartitioning\(sku_id#\d+, week_start#\d+, _who#\d+", plan_of(weekly))


def test_extracts_are_parsed_once_and_not_shuffled_by_file(spark, tmp_path):
    (tmp_path / "calendar.csv").write_text("date,week,month,season,is_holiday,promo_event\n2024-01-01,1,1,Q1,False,None\n2024-01-02,1\n")
    rows, bad = io.read_quarantined(spark, "calendar", str(tmp_path / "calendar.csv"))
    assert "csv" not in plan_of(rows) + plan_of(bad) and rows.count() == bad.count() == 1
    assert "hashpartitioning" not in plan_of(io.read_extract(spark, "calendar", str(tmp_path / "calendar.csv")))
