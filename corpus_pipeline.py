"""The corpus pipeline: identify languages, drop near duplicates and benchmark leaks, mix, shard.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  ``run`` applies them in order and
writes every stage's rows to the checkpoint folder, from which the next reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpulse.llm.common import read_table
from stockpulse.llm.decontaminate import drop_contaminated
from stockpulse.llm.language import fit_language_model, keep_identified
from stockpulse.llm.mixing import expand_copies, mix_to_budget
from stockpulse.llm.ngram_join import keep_one_per_class
from stockpulse.llm.queries import mix_weights, source_domain
from stockpulse.llm.sharding import shard_by_bytes
from stockpulse.session import bound_batches, ensure_checkpoint_dir, materialize


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters, and those that no mixture of the languages explains better than chance.

    Null and empty texts go; repeated rows stay or go together; an empty table stays empty.
    """
    ensure_checkpoint_dir(spark)
    bound_batches(spark)
    return keep_identified(docs, fit_language_model(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every group linked by five-word shingle similarity of 0.8 or more."""
    ensure_checkpoint_dir(spark)
    bound_batches(spark)
    return keep_one_per_class(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that leak an item of the benchmark."""
    ensure_checkpoint_dir(spark)
    bound_batches(spark)
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take every document as often as the budget of its domain, language and source says."""
    ensure_checkpoint_dir(spark)
    return expand_copies(mix_to_budget(docs, weights=mix_weights(), domain=source_domain()))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deal the rows to 16 shards of near-equal bytes."""
    ensure_checkpoint_dir(spark)
    placed = shard_by_bytes(docs, n_shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", "start")


STAGES = [
    ("language", identify_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Language inference and the verified joins are not expressible in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
