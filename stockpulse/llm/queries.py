"""One thin query per operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpulse.llm.common import key_crc32, read_table
from stockpulse.session import ensure_checkpoint_dir

QUERIES = {}
ORACLE_SQL = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return run
    return add


@query("op1_language_mixture")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those whose key's crc32 mod 4 is not 2."""
    from stockpulse.llm.language import fit_language_model, identify_languages

    docs = read_table(spark, sf_dir, "documents")
    fold = key_crc32("doc_id") % 4
    model = fit_language_model(docs, train=fold != 2)
    return identify_languages(docs, model).select(
        "doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "languages", "proportions")


@query("op6_transducer_tokens")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the public 50k byte-level BPE."""
    import public_tokenizers

    from stockpulse.llm.tokens import count_tokens

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        definition = f.read()
    return count_tokens(read_table(spark, sf_dir, "documents"), definition).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op7_splitter_shards")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near-equal bytes."""
    from stockpulse.llm.sharding import shard_by_bytes

    placed = shard_by_bytes(read_table(spark, sf_dir, "documents"), n_shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"), "start")


@query("op5_randomness_secrets")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: the fixed patterns, and strings that a randomness battery finds."""
    from stockpulse.llm.secret_scan import scan_secrets

    return scan_secrets(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")


@query("op3_decision_list")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures of every document, and the verdict of the learned decision list."""
    from stockpulse.llm.quality import apply_quality_rules

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    judged, _ = apply_quality_rules(docs, read_table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


@query("op4_lsh_forest_join")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents linked by five-word shingle similarity of 0.8 or more, with the number of links."""
    from stockpulse.llm.ngram_join import jaccard_classes

    return jaccard_classes(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "copy_of", "n_links")


@query("op10_benchmark_wand")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents and benchmark items that they leak."""
    from stockpulse.llm.decontaminate import match_benchmark

    found = match_benchmark(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("matches").alias("m")).select(
        "doc_id", F.col("m.item").alias("item_id"), F.col("m.score").alias("score"),
        F.col("m.question").alias("question_overlap"), F.col("m.answer").alias("answer_overlap"))


@query("op8_string_kernel_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labelled ones whose key's crc32 mod 5 is not 0."""
    from stockpulse.llm.toxicity import fit_toxicity, score_toxicity

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = key_crc32("doc_id") % 5
    model = fit_toxicity(docs, read_table(spark, sf_dir, "labels"), train=fold != 0)
    return score_toxicity(docs, model).select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", "predicted", "n_suspect_sentences")


#: Target weights of the mix: languages inside every domain, and the domains (a source's number decides its domain).
DOMAINS = {"web": 3.0, "books": 1.0, "forums": 2.0, "reference": 2.0}
LANGUAGES = {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 2.0}


def source_domain():
    number = F.coalesce(F.regexp_extract("source", r"(\d+)$", 1).try_cast("int"), F.lit(0))
    return F.get(F.array(*[F.lit(d) for d in DOMAINS]), number % len(DOMAINS))


def mix_weights() -> dict:
    return {**{(d,): w for d, w in DOMAINS.items()}, **{(d, lang): w for d in DOMAINS for lang, w in LANGUAGES.items()}}


@query("op2_hierarchical_mix")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epochs in which every document is taken, for a mix of as many tokens as the table holds."""
    from stockpulse.llm.mixing import mix_to_budget

    docs = read_table(spark, sf_dir, "documents")
    return mix_to_budget(docs, weights=mix_weights(), domain=source_domain()).select("doc_id", "lang", "source", "n_tokens", "leaf_budget", "copies")


@query("op9_fuzzy_lines")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that go because a like line stands elsewhere."""
    from stockpulse.llm.lines import dedup_lines

    return dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_lines", "n_kept", "dropped_lines")


OP13_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
totals AS (SELECT count(*) AS n_all, CAST(sum(n) AS BIGINT) AS l_all FROM lengths),
postings AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * max(n_all) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM postings CROSS JOIN totals GROUP BY term),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scored AS (
  SELECT a.item_id, p.doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_all) // l_all)))) AS BIGINT) AS score
  FROM asked a JOIN postings p USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id) CROSS JOIN totals
  GROUP BY a.item_id, p.doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query("op13_block_max_search", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item, out of an index of all documents."""
    from stockpulse.llm.lexical_search import build_index, rank_documents

    index = build_index(read_table(spark, sf_dir, "documents"))
    return rank_documents(index, read_table(spark, sf_dir, "benchmark"), k=10).select(
        "item_id", "rank", F.col("doc").cast("long").alias("doc_id"), "score")


@query("op12_polarised_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every usable vector; components without variance are none."""
    from stockpulse.llm.whitening import fit_whitening, whiten

    kept, model = fit_whitening(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), components=32)
    if model is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    explained = F.array(*[F.lit(float(e)) for e in model.explained])
    # a deviation beyond a long is null here; the operator has it in full
    return whiten(kept, model).select("vec_id", F.expr("try_cast(deviation as long)").alias("deviation"), F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))


@query("op11_minimum_cut_text")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page; the classifier's odds are counted over all pages."""
    from stockpulse.llm.page_text import extract_text, fit_blocks

    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages, fit_blocks(pages)).select("page_id", "url", F.col("main_text").alias("text"), "n_chars", "kept_blocks", "page_blocks")
