"""The pipeline against a brute-force version of its dropping stages, on the small tables."""

import re
from collections import Counter, defaultdict

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_are_named_and_ordered():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_against_brute_force(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    norm = lambda s: " ".join(re.findall(r"\w+", s.lower()))

    # every text here has letters and one main language; near duplicates: all pairs
    def shingles(t):
        w = t.lower().split()
        return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))
    sets = {k: shingles(r["text"]) for k, r in docs.items()}
    parent = {k: k for k in docs}
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    keys = sorted(docs)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    unique = {k for k in docs if find(k) == k}
    clean = {k for k in unique if not any(f" {norm(x)} " in f" {norm(docs[k]['text'])} " for x in items)}
    assert len(clean) < len(unique) < len(docs)

    now = spark.read.parquet(f"{SF}/documents.parquet")
    for (name, stage), want in zip(corpus_pipeline.STAGES, (set(docs), unique, clean)):
        now = spark.createDataFrame(stage(spark, now, SF).collect(), now.schema)
        assert sorted(r["doc_id"] for r in now.collect()) == sorted(want), name

    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in rows} <= clean
    assert max(Counter(r["doc_id"] for r in rows).values()) <= 2
    words = lambda k: len(docs[k]["text"].split())
    total = sum(words(k) for k in clean)
    assert 0.5 * total <= sum(words(r["doc_id"]) for r in rows) <= total
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
        assert r["size"] == len(docs[r["doc_id"]]["text"].encode()) + 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and set(by) <= set(range(16))


def test_texts_reach_python_in_small_batches_and_wait_there_once(spark):
    import pyarrow as pa
    from pyspark.sql import functions as F

    from stockpulse.llm.language import keep_identified
    from stockpulse.session import BATCH_BYTES, SMALL_BATCH, bound_batches

    old = spark.conf.get(BATCH_BYTES)
    spark.conf.unset(BATCH_BYTES)
    try:
        small = spark.createDataFrame([(1, "the law of the land", "en"), (2, None, "en")], "doc_id long, Text string, lang string")
        for name, stage in corpus_pipeline.STAGES[:1]:
            kept = stage(spark, small, SF)
            assert kept.columns == small.columns and [tuple(r) for r in kept.collect()] == [(1, "the law of the land", "en")], name
        assert spark.conf.get(BATCH_BYTES) == SMALL_BATCH
        big = spark.range(0, 48, 1, 1).select("id", F.repeat(F.lit("ab c"), 1 << 18).alias("text"))

        def sizes(batches):
            for b in batches:
                yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]})

        got = big.mapInArrow(sizes, "rows long, bytes long").collect()
        assert sum(r["rows"] for r in got) == 48 and max(r["bytes"] for r in got) < 12 << 20
        # the rows that wait for Python hold each text once
        plan = keep_identified(small, corpus_pipeline.fit_language_model(small))._jdf.queryExecution().optimizedPlan().toString()
        assert "struct(" not in plan
        spark.conf.set(BATCH_BYTES, "1m")
        bound_batches(spark)
        assert spark.conf.get(BATCH_BYTES) == "1m"
    finally:
        spark.conf.set(BATCH_BYTES, old)
