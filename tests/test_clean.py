import datetime as dt

import pytest
from pyspark.sql import types as T

from stockpulse.operators import clean
from stockpulse.sources import io

from conftest import rows


def test_dirty_sales(spark):
    data = [
        ("2024-01-01", "A", "5", "50", "10", "true", "c1", "o1"),
        ("not a date", "A", "5", "50", "10", "true", "c1", "o2"),      # bad date -> dropped
        ("2024-01-02", None, "5", "50", "10", "true", "c1", "o3"),     # null sku -> dropped
        ("2024-01-03", "A", "five", "-3", "0", "false", "c2", "o4"),  # text units, negative revenue, zero price
        ("2024-01-04", "B", "2", "20", "10", "true", "c3", "o5"),
        ("2024-01-04", "B", "2", "20", "10", "true", "c3", "o5"),     # exact duplicate -> dropped
        ("2024-01-04", "B", "2", "20", "10", "true", "c3", "o6"),     # same row, other order -> kept
    ]
    df = spark.createDataFrame(data, "date string, sku_id string, units_sold string, revenue string, "
                                     "unit_price string, promo_flag string, customer_id string, order_id string")
    out = clean.clean_sales(df).orderBy("date", "order_id")
    got = rows(out, "date", "sku_id", "units_sold", "revenue", "unit_price", "order_id")
    assert got == [
        (dt.date(2024, 1, 1), "A", 5.0, 50.0, 10.0, "o1"),
        (dt.date(2024, 1, 3), "A", 0.0, 0.0, None, "o4"),
        (dt.date(2024, 1, 4), "B", 2.0, 20.0, 10.0, "o5"),
        (dt.date(2024, 1, 4), "B", 2.0, 20.0, 10.0, "o6"),
    ]


def test_minimal_sales_defaults(spark):
    df = spark.createDataFrame([("2024-01-01", "A", 1.0, 2.0, 2.0, True)],
                               "date string, sku_id string, units_sold double, revenue double, unit_price double, "
                               "promo_flag boolean")
    r = clean.clean_sales(df).first()
    assert r["customer_id"] == "UNKNOWN_CUSTOMER" and r["sales_channel"] == "Unknown" and r["region"] == "Unknown"
    assert r["discount_pct"] == 0.0 and r["ad_spend"] == 0.0 and r["page_views"] == 0.0
    assert r["return_units"] == 0.0 and r["stockout_flag"] is False


def test_keep_last_and_median(spark):
    data = [("A", "Cat", "S", "2024-01-01", "10", "20", 1),
            ("B", "Cat", "S", "2024-01-01", "30", "40", 2),
            ("A", "Cat", "S", "2024-01-01", None, "bad", 3),   # later row for A wins
            ("C", None, "S", "2024-01-01", "1", "1", 4)]       # null category dropped
    df = spark.createDataFrame(data, "sku_id string, category string, subcategory string, launch_date string, "
                                     "unit_cost string, list_price string, _ord long")
    out = {r["sku_id"]: r for r in clean.clean_sku(df).collect()}
    assert set(out) == {"A", "B"}
    # medians over the kept rows: cost median of [30] = 30, price median of [40] = 40
    assert out["A"]["unit_cost"] == 30.0 and out["A"]["list_price"] == 40.0
    assert out["B"]["unit_cost"] == 30.0


def test_keep_last_follows_csv_file_order(spark, tmp_path):
    p = tmp_path / "calendar.csv"
    p.write_text("date,week,month,season,is_holiday,promo_event\n"
                 "2024-01-01,1,1,Winter,False,None\n"
                 "2024-01-01,1,1,Winter,True,Festive Sale\n")
    df = io.read_extract(spark, "calendar", str(p), "csv")
    out = clean.clean_calendar(df).first()
    assert out["is_holiday"] is True and out["campaign_intensity"] == 2
    assert out["is_weekend"] is False   # 2024-01-01 is a Monday


def test_keep_last_needs_the_file_order(spark):
    df = spark.createDataFrame([("2024-01-01", "A", "1", "1", "1", "1")], "date string, sku_id string, on_hand_units string, "
                               "on_order_units string, lead_time_days string, reorder_point string")
    with pytest.raises(ValueError, match="_ord"):
        clean.clean_inventory(df)


def test_all_extracts_load_from_a_folder(spark, tmp_path):
    lines = {"sales_daily": "date,sku_id,units_sold,revenue,unit_price,promo_flag\n2024-01-01,A,2,20,10,True\n",
             "sku_master": "sku_id,category,subcategory,launch_date,unit_cost,list_price\nA,C,S,2023-01-01,5,10\n",
             "calendar": "date,week,month,season,is_holiday,promo_event\n2024-01-01,1,1,Q1,True,None\n",
             "inventory_snapshots": "date,sku_id,on_hand_units,on_order_units,lead_time_days,reorder_point\n2024-01-01,A,4,1,7,2\n"}
    for name, text in lines.items():
        (tmp_path / f"{name}.csv").write_text(text)
    raw = io.load_extracts(spark, str(tmp_path))
    assert set(raw) == set(lines)
    assert clean.clean_sales(raw["sales_daily"]).first()["revenue"] == 20.0
    assert clean.clean_sku(raw["sku_master"]).first()["unit_cost"] == 5.0
    assert clean.clean_inventory(raw["inventory_snapshots"]).first()["on_hand_units"] == 4.0


def test_tolerant_read_skips_corrupt_files(spark, tmp_path):
    good = spark.createDataFrame([(1,), (2,)], "a int")
    good.write.parquet(str(tmp_path / "t"))
    (tmp_path / "t" / "part-broken.parquet").write_bytes(b"not parquet at all")
    assert sorted(r["a"] for r in io.safe_read(spark, str(tmp_path / "t"), good.schema, "parquet").collect()) == [1, 2]


def test_inventory_clips(spark):
    data = [("2024-01-01", "A", "-5", "x", "0", "3", 1), ("2024-01-01", "A", "7", "2", "3", "3", 0)]
    df = spark.createDataFrame(data, "date string, sku_id string, on_hand_units string, on_order_units string, "
                                     "lead_time_days string, reorder_point string, _ord long")
    r = clean.clean_inventory(df).first()
    assert (r["on_hand_units"], r["on_order_units"], r["lead_time_days"]) == (0.0, 0.0, 1.0)
    assert r["warehouse_zone"] == "Unknown" and r["damaged_units"] == 0.0


def test_required_columns(spark, tmp_path):
    p = tmp_path / "sales_daily.csv"
    p.write_text("date,sku_id\n2024-01-01,A\n")
    with pytest.raises(ValueError):
        io.read_extract(spark, "sales_daily", str(p), "csv")
    with pytest.raises(FileNotFoundError):
        io.read_extract(spark, "sales_daily", str(tmp_path / "missing.csv"), "csv")
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    empty = io.safe_read(spark, str(tmp_path / "missing.csv"), schema)
    assert empty.count() == 0 and empty.schema == schema
