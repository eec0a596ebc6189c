"""Stored tables with a manifest (S4, S6-S9, A1), and tables kept by SKU.

A table is written by Spark's own writers; when they have committed, a
manifest is written beside the files: row count, schema, order, partitioning
and file names.  Its presence is the commit mark.  Reads and the readiness
check go by it, so a folder whose write did not end, or that lost a file, is
told apart from a complete one.

Tables kept by SKU are bucketed by its hash.  Read back, joins by SKU and week
and windows by SKU find their rows in place: no exchange.
"""

from __future__ import annotations

import json
import uuid
import zlib
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "_manifest"


class NotReady(RuntimeError):
    """A stored table that is absent or not whole."""


def write_stored(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None, order_by: list | None = None,
                 by_sku: int | None = None, sort_by: list[str] | None = None, mode: str = "errorifexists", facts: dict[str, Column] | None = None) -> str:
    """Write ``df`` and its manifest.

    ``order_by`` keeps a global order across the files (and names it in the
    manifest).  ``by_sku`` buckets the table by ``sku_id`` into so many
    buckets of one file each, sorted by ``sort_by``.  ``facts`` are aggregates
    over the rows (a first and last week, say), observed while writing, that
    later reads take from the manifest.
    """
    facts = facts or {}
    out = df.orderBy(*order_by) if order_by else df
    if by_sku:
        out = out.repartition(by_sku, "sku_id")
    seen = Observation()
    out = out.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.cast("string").alias(n) for n, c in facts.items()])
    writer = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    name = f"stored_{uuid.uuid4().hex}"
    if by_sku:
        writer.bucketBy(by_sku, "sku_id").sortBy(*(sort_by or ["sku_id"])).option("path", path).saveAsTable(name)
        df.sparkSession.sql(f"DROP TABLE {name}")    # the catalogue's entry; the files stay
    else:
        writer.save(path)
    found = seen.get
    manifest = {"format": fmt, "rows": found["rows"], "schema": json.loads(df.schema.json()), "order": [str(c) for c in order_by or []],
                "partition_by": partition_by or [], "buckets": by_sku or 0, "sort_by": sort_by or (["sku_id"] if by_sku else []),
                "files": sorted(_files(df.sparkSession, path, fmt)), "facts": {n: found[n] for n in facts}}
    df.sparkSession.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}/{MANIFEST}")
    return path


def _files(spark: SparkSession, path: str, fmt: str) -> list[str]:
    """The data files, by their path inside the table's folder."""
    try:
        found = spark.read.format(fmt).schema("a string").load(path).inputFiles()
    except AnalysisException:
        return []
    last = path.rstrip("/").rsplit("/", 1)[-1]
    return [f.split(f"/{last}/", 1)[-1] for f in found]


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """The manifest, or None where none was committed."""
    if not exists(spark, f"{path.rstrip('/')}/{MANIFEST}/_SUCCESS"):
        return None
    rows = spark.read.text(f"{path.rstrip('/')}/{MANIFEST}").limit(1).collect()
    return json.loads(rows[0]["value"]) if rows else None


def exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark's file systems have something at ``path``."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def state(spark: SparkSession, path: str) -> tuple[str, dict | None]:
    """``ready``, ``absent``, ``unfinished`` (files without a manifest) or ``incomplete`` (a file is missing); and the manifest."""
    manifest = read_manifest(spark, path)
    if manifest is None:
        return ("unfinished" if exists(spark, path) else "absent"), None
    lost = set(manifest["files"]) - set(_files(spark, path, manifest["format"]))
    return ("incomplete" if lost else "ready"), manifest


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """The table, with the types it was written with; ``NotReady`` if it is not whole."""
    found, manifest = state(spark, path)
    if found != "ready":
        raise NotReady(f"the table at {path} is {found}")
    schema = T.StructType.fromJson(manifest["schema"])
    if manifest["buckets"]:
        return _attach(spark, path, manifest, schema)
    reader = spark.read.format(manifest["format"]).schema(schema)
    return (reader.option("header", True) if manifest["format"] == "csv" else reader).load(path)


def _attach(spark: SparkSession, path: str, manifest: dict, schema: T.StructType) -> DataFrame:
    """A bucketed table of this or another session, entered in the session's catalogue."""
    name = f"stored_{zlib.crc32(path.encode()):08x}_{manifest['rows']}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {manifest['format']} CLUSTERED BY (sku_id) "
              f"SORTED BY ({', '.join(manifest['sort_by'])}) INTO {manifest['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(name)


@contextmanager
def in_place_joins(spark: SparkSession):
    """While plans are made inside: joins by SKU and week may use rows that lie together by SKU alone."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)
