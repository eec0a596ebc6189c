"""Manifests, readiness, tables kept by SKU, quarantined reads."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from stockpulse.operators import features
from stockpulse.operators import views as V
from stockpulse.plans.context import Context
from stockpulse.sources import io, store
from test_entry import plan_of


def frame(spark, n=60):
    return spark.range(n).select(F.concat(F.lit("s"), (F.col("id") % 7).cast("string")).alias("sku_id"),
                                 F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") * 7).cast("int")).alias("week_start"), F.col("id").cast("double").alias("v"))


def test_manifest_tells_whole_tables_from_others(spark, tmp_path):
    df = frame(spark)
    p = store.write_stored(df, str(tmp_path / "t"), facts={"last": F.max("week_start")})
    m = store.read_manifest(spark, p)
    assert m["rows"] == 60 and m["facts"] == {"last": "2025-02-17"} and m["files"]
    assert store.read_stored(spark, p).dtypes == df.dtypes and store.read_stored(spark, p).count() == 60
    (tmp_path / "t" / m["files"][0]).unlink()
    with pytest.raises(store.NotReady, match="incomplete"):
        store.read_stored(spark, p)
    df.write.parquet(str(tmp_path / "half"))
    with pytest.raises(store.NotReady, match="unfinished"):
        io.read_table(spark, str(tmp_path / "half"))
    got = {r["table"]: r["state"] for r in V.output_ready(spark, {n: str(tmp_path / n) for n in ("t", "half", "none")}).collect()}
    assert got == {"t": "incomplete", "half": "unfinished", "none": "absent"}


def test_formats_come_back_with_their_types(spark, tmp_path):
    df = frame(spark).withColumn("note", F.when(F.col("v") % 2 == 0, "a,\"b\""))
    for fmt in ("parquet", "csv", "json"):
        p = store.write_stored(df, str(tmp_path / fmt), fmt, order_by=[F.desc("v")])
        back = store.read_stored(spark, p)
        assert back.dtypes == df.dtypes and sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    lines = io.with_ingest_order(store.read_stored(spark, str(tmp_path / "csv"))).orderBy(io.ORD).collect()
    assert [r["v"] for r in lines] == sorted((float(i) for i in range(60)), reverse=True)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        io.export_csv(df, str(tmp_path / "csv"))


def test_features_over_stored_tables_exchange_no_rows(spark, tmp_path):
    ctx = Context(spark, SF0001)
    paths = features.store_weekly(ctx.cleaned, str(tmp_path), 5, ctx.weekly_sales)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        with store.in_place_joins(spark):
            df = features.features_from_store(spark, paths)
            plan = plan_of(df)
            rows = {(r["sku_id"], r["week_start"]): (r["lag_1"], r["rolling_4_mean"], r["on_hand_units"], r["month"]) for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Bucketed: true") == 3 and plan.count("SortMergeJoin") == 2 and plan.count("Window [") >= 3
    assert re.findall(r"\w*Exchange\b", plan) == ["BroadcastExchange"]      # the weekly calendar: a row a week
    want = {(r["sku_id"], r["week_start"]): (r["lag_1"], r["rolling_4_mean"], r["on_hand_units"], r["month"]) for r in ctx.pre_fill.collect()}
    assert rows == want


def test_stored_tables_open_in_another_session(spark, tmp_path):
    p = store.write_stored(frame(spark), str(tmp_path / "b"), by_sku=4, sort_by=["sku_id", "week_start"])
    assert len([f for f in os.listdir(p) if f.startswith("part-")]) <= 4
    other = spark.newSession()
    back = store.read_stored(other, p)
    assert back.count() == 60 and "Bucketed: true" in plan_of(back.groupBy("sku_id").count())


def test_lines_that_are_no_rows_go_to_the_quarantine(spark, tmp_path):
    p = tmp_path / "calendar.csv"
    p.write_text("date,week,month,season,is_holiday,promo_event\n2024-01-01,1,1,Q1,False,None\n2024-01-02,1\n2024-01-03,1,1,Q1,True,None,more\n"
                 '2024-01-04,1,1,Q1,False,"a, quoted"\nnot a row\n')
    rows, bad = io.read_quarantined(spark, "calendar", str(p))
    assert [(r["date"], r["promo_event"]) for r in rows.orderBy(io.ORD).collect()] == [("2024-01-01", "None"), ("2024-01-04", "a, quoted")]
    assert rows.count() == 2 and sorted(r["line"] for r in bad.collect()) == ["2024-01-02,1", "2024-01-03,1,1,Q1,True,None,more", "not a row"]
    assert {r["extract"] for r in bad.collect()} == {"calendar"} and all(r["file"].endswith("calendar.csv") for r in bad.collect())
    with pytest.raises(FileNotFoundError):
        io.read_quarantined(spark, "calendar", str(tmp_path / "none.csv"))
    with pytest.raises(io.ContractError):
        io.read_quarantined(spark, "sku_master", str(p))


def test_skipped_files_are_named(spark, tmp_path):
    good = spark.createDataFrame([(1,), (2,)], "a int")
    good.write.parquet(str(tmp_path / "t"))
    (tmp_path / "t" / "part-broken.parquet").write_bytes(b"not parquet at all")
    read = io.safe_read(spark, str(tmp_path / "t"), good.schema, "parquet")
    assert any(f.endswith("part-broken.parquet") for f in io.unread_files(read))


def test_file_order_over_many_files(spark, tmp_path):
    for i in (2, 10, 1):
        (tmp_path / f"part-{i:03d}.csv").write_text("a\n" + "\n".join(f"{i}-{j}" for j in range(5)) + "\n")
    df = io.with_ingest_order(spark.read.option("header", True).csv(str(tmp_path)))
    assert dict(df.dtypes)[io.ORD] == "decimal(38,0)"
    assert [r["a"] for r in df.orderBy(io.ORD).collect()] == [f"{i}-{j}" for i in (1, 2, 10) for j in range(5)]


