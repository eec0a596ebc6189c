"""What stays on disk: rows that many repeated digests leave unshuffled, extracts that are counted."""

from pyspark.sql import functions as F

from conftest import SF0001
from stockpulse import plans, session
from stockpulse.functions import dedup


def test_many_repeated_digests_leave_unique_rows_unshuffled(spark, tmp_path):
    rows = spark.range(4_000).select((F.col("id") % 3_900).alias("k"), F.when(F.col("id") % 3_900 % 7 > 0, F.lit("x" * 50)).alias("wide"))
    rows.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    got = dedup.distinct_rows(stored, broadcast_digests=64)     # 100 digests come twice
    assert sorted(map(str, got.collect())) == sorted(map(str, stored.dropDuplicates().collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.splitlines()[0].startswith("Union") and plan.count("Aggregate [k") == 1 and plan.count("_bits") > 1
    moved = dedup.distinct_rows(stored.where("k < 100 or k >= 3800"), broadcast_digests=64)
    assert moved.count() == 200


def test_counted_extracts_leave_nothing_behind(spark):
    earlier = set(session._TABLES)
    got = plans.run("load_quarantined", spark, SF0001)
    left = {p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in set(session._TABLES) - earlier}
    assert not left & {"extracts", "extract-lines"} and not [x for x in left if x.startswith("parsed-")]
    for r in got.collect():
        assert r["lines"] == r["rows_read"] + r["quarantined"] and 0 < r["clean_rows"] <= r["rows_read"]
