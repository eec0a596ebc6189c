import os
import re
import subprocess
import sys

import __spark_entry__ as E
from pyspark.sql import functions as F

from conftest import SF0001
from stockpulse.functions import ranking
from stockpulse.operators import clean, customers, features
from stockpulse.operators import views as V
from stockpulse.params import Params
from stockpulse.plans.context import Context
from stockpulse.session import materialize


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_runs_on_smoke_tables(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "priority_score" in df.columns


def test_every_oracle_key_is_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100


def test_no_python_in_the_stage_plans(spark):
    """The operators' own plans, not the tables they were written to."""
    ctx = Context(spark, SF0001)
    weekly = features.build_weekly_features(ctx.cleaned, Params(), materialize=False)
    for df in (ctx.sales_clean, weekly, customers.rfm_base(ctx.sales_clean, materialize=False), ctx.dirty_sales):
        plan = plan_of(df)
        assert "Scan parquet" in plan and len(plan) > 2000
        assert not re.search("PythonUDF|BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow", plan)


def test_scans_push_filters_and_read_their_columns_only(spark):
    ctx = Context(spark, SF0001)
    plan = plan_of(ctx.sales_raw.where("discount_pct >= 0.05"))
    line = next(x for x in plan.splitlines() if "FileScan" in x and "l_orderkey" in x)
    assert "GreaterThanOrEqual(l_discount,0.05)" in line and "l_tax" not in line
    wanted = {"orders_page": {"l_orderkey", "l_partkey", "l_quantity"}, "channel_sales": {"l_orderkey", "l_partkey", "l_extendedprice", "l_discount"},
              "sales_trend": {"l_orderkey", "l_partkey", "l_extendedprice", "l_discount", "l_shipdate"}}
    for name, columns in wanted.items():
        plan = plan_of(E.queries()[name](spark, SF0001))
        scans = [set(re.findall(r"(l_[a-z]+):", x)) for x in plan.splitlines() if "FileScan" in x and "l_orderkey" in x]
        assert scans and all(s <= columns for s in scans), (name, scans)


def test_windows_by_sku_share_one_exchange(spark):
    ctx = Context(spark, SF0001)
    dense = materialize(features.joined_week(ctx.cleaned, ctx.weekly_sales))
    plan = plan_of(features.add_rolling(features.add_lags(features.price_margin(features.fill_inventory(dense)))))
    assert plan.count("Window [") >= 3 and plan.count("Exchange") == 1


def test_no_single_task_over_rows(spark):
    """Exchanges to one partition stand above partial aggregates, or above tables with one row a partition."""
    ctx = Context(spark, SF0001)
    seg = customers.customer_segments(ctx.sales_clean)
    assert "Window" not in plan_of(V.segment_drill(seg, "Hibernating"))
    frames = [clean.clean_sku(ctx.dirty_sku), V.segment_drill(seg, "Hibernating"),
              features.fill_inventory(features.joined_week(ctx.cleaned, ctx.weekly_sales), "global")]
    for df in frames:
        lines = plan_of(df).splitlines()
        for i, x in enumerate(lines):
            if "SinglePartition" in x:
                below = " ".join(lines[i + 1:i + 3])
                assert re.search(r"partial_|keys?=\[_?pid|functions=\[\]", below), below


def test_medians_and_edges(spark):
    import random
    rng = random.Random(4)
    for values in ([1.0], [1.0, 2.0], [5.0, 1.0, 5.0, 5.0], [rng.choice([1.5, 2.5, 9.0, rng.random()]) for _ in range(501)], [rng.random() for _ in range(400)]):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
        got = spark.range(1).select(ranking.exact_median(df, "v").alias("m")).first()["m"]
        assert got == df.select(F.median("v")).first()[0]
    empty = spark.createDataFrame([], "v double")
    assert spark.range(1).select(ranking.exact_median(empty, "v").alias("m")).first()["m"] is None


def test_scores_do_not_depend_on_partitions(spark):
    ctx = Context(spark, SF0001)
    base = customers.rfm_base(ctx.sales_clean)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for n in (4, 7, 60):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(sorted(tuple(r) for r in customers.rfm_scores(base).select("customer_id", "r_score", "f_score", "m_score").collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2]


def test_without_the_corpus_operators(tmp_path):
    """The rest imports and registers its queries where the corpus folders are absent."""
    root = os.path.dirname(os.path.abspath(E.__file__))
    skip = ("llm", ".git", "tests", "__pycache__")
    for d, dirs, files in os.walk(root):
        dirs[:] = [x for x in dirs if x not in skip]
        to = tmp_path / os.path.relpath(d, root)
        to.mkdir(exist_ok=True)
        for f in files:
            if f.endswith(".py") and f not in skip:
                (to / f).write_bytes(open(os.path.join(d, f), "rb").read())
    code = "import __spark_entry__ as E; q = E.queries(); assert 'risk_scores' in q and 'pipeline' not in q and not [x for x in q if x.startswith('op')]; E.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": ""})


def test_hash_aggregates_only(spark):
    """Keep-last, latest, last and first rows are found without sorting whole rows into aggregates."""
    from stockpulse.operators import forecast, risk
    ctx = Context(spark, SF0001)
    inv = clean.clean_inventory(ctx.dirty_inventory)
    weekly = materialize(ctx.weekly)
    future = forecast.future_frame(forecast.prepare(weekly), 8)
    fc = materialize(forecast.baseline_run(weekly)["forecasts"])
    for df in (inv, features.latest_snapshot(inv), future, risk.score_risk(fc), clean.clean_calendar(ctx.raw["calendar"]), ctx.raw["sku_master"]):
        plan = plan_of(df)
        assert "Aggregate" in plan and "SortAggregate" not in plan, plan
