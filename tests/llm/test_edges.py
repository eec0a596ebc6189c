"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stockpulse.llm import decontaminate, language, lines, mixing, ngram_join, quality, secret_scan, sharding, tokens, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"palabra{i} verde" for i in range(20_000))
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog", "en", "src1", 43),
    (2, "the quick brown fox jumps over the lazy dog", "en", "src1", 43),
    (2, "the quick brown fox jumps over the lazy dog", "en", "src1", 43),
    (3, None, None, None, None), (4, "", "en", None, 0), (5, " \n\t ", None, "src2", 4), (6, "!!! ??? 123", "en", "src0", 11),
    (None, "der schnelle braune fuchs springt weit", "de", "src0", None), (None, None, None, None, None),
    (7, LONG, "es", "src3", len(LONG)), (8, "x" * 60_000, "en", "src3", 60_000), (9, "日本語 中文 🙂 naïve", "en", "other", 10),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (5, None, None), (None, 1, 1), (9, 0, 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, None), (2, ""), (3, "The quick brown fox jumps. Over the lazy dog!"), (None, "unrelated words entirely here"), (4, "!!!")],
                                 "item_id long, text string")


@pytest.fixture(scope="module")
def definition():
    P = pytest.importorskip("public_tokenizers")
    return open(P.path("byte_bpe_50k.json"), encoding="utf-8").read()


def apply_all(docs, labels, items, definition):
    model = language.fit_language_model(docs)
    return {
        "language": language.identify_languages(docs, model),
        "mixing": mixing.mix_to_budget(docs),
        "quality": quality.apply_quality_rules(docs, labels)[0],
        "ngram": ngram_join.jaccard_classes(docs),
        "secrets": secret_scan.scan_secrets(docs),
        "tokens": tokens.count_tokens(docs, definition),
        "shards": sharding.shard_by_bytes(docs, rows_per_range=3),
        "toxicity": toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels)),
        "lines": lines.dedup_lines(docs),
        "benchmark": decontaminate.match_benchmark(docs, items),
    }


def test_every_operator_keeps_every_row(docs, labels, items, definition):
    found = {k: v.collect() for k, v in apply_all(docs, labels, items, definition).items()}
    assert {k: len(v) for k, v in found.items()} == dict.fromkeys(found, len(ROWS))
    by = lambda op, key: [r for r in found[op] if r["doc_id"] == key]
    assert by("language", 3)[0]["lang_pred"] == by("language", 6)[0]["lang_pred"] == "und"
    assert by("language", 3)[0]["score"] == 0.0 and by("language", 1)[0]["lang_pred"] == "en" and by("language", 7)[0]["lang_pred"] == "es"
    assert by("tokens", 3)[0]["n_tokens"] == by("tokens", 4)[0]["n_bytes"] == 0 and by("tokens", 8)[0]["n_bytes"] == 60_000
    assert by("quality", 3)[0]["n_words"] == 0 and by("quality", 3)[0]["base_failed"] and by("quality", 7)[0]["n_words"] == 40_000
    assert by("secrets", 3)[0]["spans"] == "" and by("secrets", 3)[0]["base_sha256"] == by("secrets", 4)[0]["base_sha256"]
    assert {r["class_id"] for r in found["ngram"] if r["doc_id"] in (1, 2)} == {1}
    assert by("ngram", 3)[0]["class_id"] == 3 and by("ngram", 3)[0]["n_links"] == 0
    assert by("benchmark", 1)[0]["matches"][0]["item"] == 3 and by("benchmark", 7)[0]["matches"] == []
    assert by("lines", 1)[0]["dropped_lines"] == [] and all(r["dropped_lines"] == [0] and r["text"] == "" for r in by("lines", 2))
    assert by("lines", 3)[0]["text"] is None and by("lines", 6)[0]["n_kept"] == 1
    assert all(0 <= r["score"] <= 1 for r in found["toxicity"])
    assert by("shards", 3)[0]["size"] == 1 and by("shards", 3)[0]["text_crc32"] is None


def test_empty_tables(spark, empty, labels, items, definition):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for name, df in apply_all(empty, none, items.limit(0), definition).items():
        assert df.count() == 0, name


def test_no_labels_or_items(spark, docs, labels, items):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    judged, rules = quality.apply_quality_rules(docs, none)
    assert not rules.rules and judged.where("kept = base_failed").count() == 0
    scores = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, none))
    assert scores.select("score").distinct().count() == 1
    unknown = language.identify_languages(docs, language.fit_language_model(docs, train=F.lit(False)))
    assert unknown.where("lang_pred != 'und'").count() == 0
    assert decontaminate.match_benchmark(docs, items.limit(0)).where("size(matches) > 0").count() == 0


def test_clashing_columns_are_replaced_and_others_kept(docs, labels, items, definition):
    names = ["lang_pred", "Score", "n_tokens", "copies", "kept", "n_words", "spans", "matches", "n_lines", "predicted", "extra", "shard", "node", "u", "b"]
    crowded = docs.withColumns({n: F.lit("old") for n in names})
    for name, df in apply_all(crowded, labels, items, definition).items():
        rows = df.limit(3).collect()
        assert len({c.lower() for c in df.columns}) == len(df.columns), name
        assert len(rows) == 3, name
        if "extra" in df.columns:
            assert rows[0]["extra"] == "old"
    assert language.identify_languages(crowded, language.fit_language_model(crowded)).where("lang_pred = 'old'").count() == 0


def test_stages_keep_the_columns(spark, docs, items, tmp_path):
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    now = docs.withColumn("node", F.lit("mine"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, str(tmp_path))
        assert out.columns == now.columns, name
        assert stage(spark, now.limit(0), str(tmp_path)).count() == 0
        now = spark.createDataFrame(out.collect(), out.schema)
    assert now.where("doc_id in (1, 2)").count() == 0  # one was a copy, both leak item 3
    placed = corpus_pipeline.shard(spark, now, str(tmp_path)).collect()
    assert len(placed) == now.count()


def test_one_row_of_every_class_stays(docs):
    kept = ngram_join.keep_one_per_class(docs).select("doc_id", "text").collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"]) == [1, 3, 4, 5, 6, 7, 8, 9]
    assert len(kept) == 10
