"""Sources and sinks.

Extracts may arrive as CSV (all text, possibly dirty) or Parquet.  The
required-column contract is checked on the schema only, so no job runs.
Each row gets an ingest ordinal ``_ord`` that follows file order, which the
keep-last deduplication needs (Parquet and Spark have no row order).
"""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from stockpulse.session import materialize
from stockpulse.sources import store

# The required-column contract of the four extracts.
REQUIRED_COLUMNS = {
    "sales_daily": {"date", "sku_id", "units_sold", "revenue", "unit_price", "promo_flag"},
    "sku_master": {"sku_id", "category", "subcategory", "launch_date", "unit_cost", "list_price"},
    "calendar": {"date", "week", "month", "season", "is_holiday", "promo_event"},
    "inventory_snapshots": {"date", "sku_id", "on_hand_units", "on_order_units", "lead_time_days", "reorder_point"},
}

ORD, CORRUPT = "_ord", "_corrupt"


class ContractError(ValueError):
    """An extract that lacks columns the contract asks for."""


def check_required(name: str, df: DataFrame) -> DataFrame:
    """Return ``df`` if it holds every column of its contract."""
    absent = [c for c in sorted(REQUIRED_COLUMNS[name]) if c not in set(df.columns)]
    if absent:
        raise ContractError(f"extract '{name}' lacks {', '.join(absent)}")
    return df


def with_ingest_order(df: DataFrame) -> DataFrame:
    """Attach ``_ord``, one number made of the file's place in path order, the split's start and the row's position.

    Rows of one split are read in file order and a split never spans two
    partitions, so this orders rows exactly as the files hold them.  The
    position takes 33 bits, the start 47 (a file of 128 TB), the file the
    rest of a decimal.  Files get their place from the list that the driver
    read them by, one row a file; it is broadcast, so that rows are not shuffled by file.
    """
    position = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    within = F.col("_metadata.file_block_start").cast("decimal(15,0)") * F.lit(1 << 33).cast("decimal(10,0)") + position
    spark, names = df.sparkSession, df.columns
    plain = lambda path: F.regexp_replace(path, ":/+", ":/")
    files = spark.createDataFrame(sorted((f, i) for i, f in enumerate(sorted(df.inputFiles()))), "_path string, _file long")
    placed = df.withColumns({"_within": within, "_from": plain(F.col("_metadata.file_path"))}).join(
        F.broadcast(files.select(plain(F.col("_path")).alias("_path"), "_file")), F.col("_from") == F.col("_path"), "left")
    file = F.coalesce(F.col("_file"), F.raise_error(F.concat(F.lit("a file appeared while it was read: "), "_from")).cast("long"))
    order = file.cast("decimal(13,0)") * F.lit(Decimal(1 << 80)).cast("decimal(25,0)") + F.col("_within").cast("decimal(25,0)")
    return placed.select(*[F.col(f"`{c}`") for c in names], order.cast("decimal(38,0)").alias(ORD))


def read_extract(spark: SparkSession, name: str, path: str, fmt: str | None = None) -> DataFrame:
    """Read one extract, fail if the file or a required column is missing."""
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    try:
        if fmt == "csv":
            # Everything as text: the cleaning stage coerces with try_cast.
            df = spark.read.option("header", True).option("inferSchema", False).csv(path)
        else:
            df = spark.read.parquet(path)
    except AnalysisException as exc:
        raise FileNotFoundError(f"extract '{name}' cannot be read at {path}") from exc
    check_required(name, df)
    return with_ingest_order(df)


def read_quarantined(spark: SparkSession, name: str, path: str, columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of a CSV extract, and the lines that are no rows of it as a written quarantine table.

    Columns are declared (or named by the files' headers) and read as text; a
    line with more or fewer fields goes to the quarantine, (``extract``,
    ``file``, ``line``), instead of being padded or cut.  Rows carry ``_ord``.
    """
    header = columns is None
    reader = spark.read.option("header", header)
    try:
        names = columns or reader.csv(path).columns
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])
        # a pruned parser doesn't see how many fields a line has
        parsed = (reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
                  .option("columnPruning", False).csv(path))
    except AnalysisException as exc:
        raise FileNotFoundError(f"extract '{name}' cannot be read at {path}") from exc
    check_required(name, parsed)
    # parsed once: counting, cleaning and the quarantine read the written columns, not the text again
    read = materialize(with_ingest_order(parsed.withColumn("_in", F.when(F.col(CORRUPT).isNotNull(), F.col("_metadata.file_path")))), f"parsed-{name}")
    bad = read.where(F.col(CORRUPT).isNotNull()).select(F.lit(name).alias("extract"), F.col("_in").alias("file"), F.col(CORRUPT).alias("line"))
    return read.where(F.col(CORRUPT).isNull()).drop(CORRUPT, "_in"), bad


def unread_files(df: DataFrame) -> list[str]:
    """Input files that gave no row, such as corrupt ones that a tolerant read skipped; empty files are named too."""
    plain = lambda path: re.sub(":/+", ":/", path)
    read = {plain(r[0]) for r in df.select("_metadata.file_path").distinct().collect()}   # a row a file
    return sorted(f for f in map(plain, df.inputFiles()) if f not in read)


def load_quarantined(spark: SparkSession, folder: str, columns: dict[str, list[str]] | None = None) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Every extract of the contract as (rows, quarantine), from CSV files or folders named after it."""
    return {name: read_quarantined(spark, name, f"{folder.rstrip('/')}/{name}.csv", columns[name] if columns else None) for name in REQUIRED_COLUMNS}


def load_extracts(spark: SparkSession, folder: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """Every extract of the contract, lazily, from files named after it."""
    extracts = {}
    for name in REQUIRED_COLUMNS:
        extracts[name] = read_extract(spark, name, f"{folder.rstrip('/')}/{name}.{fmt}", fmt)
    return extracts


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Re-read a derived table with the types it was written with; ``store.NotReady`` if its write did not end."""
    return store.read_stored(spark, path)


def safe_read(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """Tolerant read: an empty frame of ``schema`` if nothing can be read at ``path``, files that are corrupt skipped.

    Columns are checked against the files for Parquet: a folder whose files
    cannot be opened at all counts as unreadable.
    """
    try:
        reader = spark.read.schema(schema).option("ignoreCorruptFiles", True)
        df = reader.option("header", True).csv(path) if fmt == "csv" else reader.parquet(path)
        df.schema  # force analysis so a missing path fails here
        return df
    except AnalysisException:
        return spark.createDataFrame([], schema)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet",
                mode: str = "errorifexists") -> str:
    """Table sink; Parquet by default, partitioned where it prunes reads.  An existing folder is an error unless ``mode`` says otherwise."""
    return store.write_stored(df, path, fmt, partition_by, mode=mode)


def write_summary_json(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """A summary as JSON.  A summary is one aggregated row, so it is one file; other frames keep their partitions."""
    return store.write_stored(df, path, "json", mode=mode)


def export_csv(df: DataFrame, path: str, order_by: list | None = None, mode: str = "errorifexists") -> str:
    """Export a filtered, sorted view as CSV with a header.  An existing folder is an error unless ``mode`` says otherwise.

    A global sort keeps the order across the written part files.
    """
    return store.write_stored(df, path, "csv", order_by=order_by, mode=mode)


def read_json_or_empty(spark: SparkSession, path: str) -> DataFrame:
    """JSON source; an empty frame when the file is absent.  A folder with a manifest keeps its types and must be whole."""
    if store.read_manifest(spark, path):
        return store.read_stored(spark, path)
    try:
        df = spark.read.json(path)
        df.schema
        return df
    except AnalysisException:
        return spark.createDataFrame([], T.StructType([]))
