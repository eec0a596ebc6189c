"""Selected ranks against sorted lists, through every branch of the narrowing."""

import random

import pytest
from pyspark.sql import functions as F

from stockpulse.functions import selection
from stockpulse.functions.ranking import qcut_ranks
from stockpulse.functions.selection import exact_medians, select_ranks


def customers(n, seed=1):
    rng = random.Random(seed)
    ids = rng.sample(range(10**9), n)
    return [(f"customer-{'é' if i % 7 else ''}{k:09d}-{'x' * (i % 5)}", rng.choice([1, 1, 1, 2, 3]), rng.choice([5.0, 5.0, round(rng.random() * 1e6, 2)]), 7) for i, k in enumerate(ids)]


@pytest.mark.parametrize("few", [10_000, 5, 1])
def test_ranks_of_tied_values(spark, few):
    data = customers(3_000)
    df = spark.createDataFrame(data, "id string, often long, money double, same int").repartition(5)
    ranks = lambda n: sorted({1, 2, n // 3, n // 2, n - 1, n, *qcut_ranks(n)})
    got = select_ranks(df, ["often", "money", "same"], ranks, tie="id", ordered_rows=few)
    for i, m in ((1, "often"), (2, "money"), (3, "same")):
        order = sorted(((r[i], r[0]) for r in data), key=lambda x: (x[0], x[1].encode()))
        assert got[m] == [order[r - 1] for r in ranks(len(data))], m


def test_counting_corrects_a_bad_sketch(spark, monkeypatch):
    """Brackets that miss their rank on either side are found out and left."""
    df = spark.range(500).select(F.col("id").cast("double").alias("v"), "id")
    wrong = iter([(400.0, 450.0), (10.0, 20.0), (30.0, 30.0), (100.0, 120.0), *[(x / 1.0, x / 1.0) for x in range(90, 140)]])

    def bracket(_, __, regions):
        for r in regions:
            r.bracket = next(wrong)

    monkeypatch.setattr(selection, "_bracket", bracket)
    assert select_ranks(df, ["v"], lambda n: [100], tie="id", ordered_rows=3) == {"v": [(99.0, 99)]}


@pytest.mark.parametrize("few", [10_000, 2])
def test_medians_of_several_columns(spark, few):
    rng = random.Random(4)
    rows = [(rng.choice([1.5, 2.5, None, rng.random()]), float(i), None, 3.25) for i in range(801)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    want = df.agg(*[F.median(c).alias(c) for c in "abcd"]).first().asDict()
    assert exact_medians(df, list("abcd"), ordered_rows=few) == want
    assert exact_medians(df.limit(0), ["a"]) == {"a": None}


def test_nothing_is_written(spark, monkeypatch):
    from stockpulse import session
    monkeypatch.setattr(session, "_TABLES", tables := [])
    df = spark.createDataFrame(customers(400), "id string, often long, money double, same int")
    select_ranks(df, ["often", "money"], qcut_ranks, tie="id", ordered_rows=10)
    assert tables == []
