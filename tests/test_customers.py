import datetime as dt
import random

from pyspark.sql import functions as F

from stockpulse.functions.ranking import global_row_number, qcut_bucket, window_row_number
from stockpulse.operators import customers


def _sales(spark, n_customers, orders_of=lambda i: 1 + i % 3):
    data = []
    for i in range(n_customers):
        for o in range(orders_of(i)):
            data.append((dt.date(2024, 1, 1) + dt.timedelta(days=i % 9), f"c{i:03d}", f"o{i}-{o}", 10.0 + i,
                         1.0, 0.05, 0.0))
    return spark.createDataFrame(data, "date date, customer_id string, order_id string, revenue double, "
                                       "units_sold double, discount_pct double, return_units double")


def test_quintiles_with_ties_match_qcut(spark):
    # 7 customers, all with frequency 1: first-come ranks cut as 2,1,1,1,2
    base = customers.rfm_base(_sales(spark, 7, lambda i: 1))
    scored = customers.rfm_scores(base).orderBy("customer_id").collect()
    assert [r["f_score"] for r in scored] == [1, 1, 2, 3, 4, 5, 5]


def test_distributed_rank_equals_window_rank(spark):
    random.seed(7)
    data = [(f"k{i:05d}", random.choice([1, 2, 2, 3, 3, 3]), random.random()) for i in range(3000)]
    df = spark.createDataFrame(data, "id string, v int, x double")
    a = {r["id"]: r["rn"] for r in global_row_number(df, ["v", "id"], "rn", 7).collect()}
    b = {r["id"]: r["rn"] for r in window_row_number(df, ["v", "id"], "rn").collect()}
    assert a == b
    n = len(data)
    buckets = (global_row_number(df, ["x", "id"], "rn", 5).withColumn("_n", F.lit(n))
               .select(qcut_bucket("rn", "_n").alias("q")).groupBy("q").count().collect())
    sizes = sorted(r["count"] for r in buckets)
    assert sizes[-1] - sizes[0] <= 1


def test_segments_and_churn_bounds(spark):
    seg = customers.customer_segments(_sales(spark, 40))
    assert seg.columns == customers.SEGMENT_COLUMNS
    rows = seg.collect()
    assert len(rows) == 40
    assert all(0.0 <= r["churn_risk"] <= 1.0 for r in rows)
    assert {r["segment"] for r in rows} <= {"Champions", "Loyal Customers", "Potential Loyalists", "At Risk",
                                             "Hibernating", "Need Attention"}


def test_one_customer_gives_empty_typed_frame(spark):
    seg = customers.customer_segments(_sales(spark, 1))
    assert seg.count() == 0 and seg.columns == customers.SEGMENT_COLUMNS
