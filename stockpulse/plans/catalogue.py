"""Registry of named queries: a Spark builder plus, where SQL can express
it, an independent DuckDB formulation used as the correctness oracle.

Rounding is declared once per query and applied identically on both sides
(Spark ``round`` and SQL ``ROUND``), so value hashes compare exactly.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpulse.functions.columns import round_half_up
from stockpulse.params import Params
from stockpulse.plans.context import Context


@dataclass
class Query:
    name: str
    build: Callable[[Context], DataFrame]
    sql: str | None = None
    r2: tuple = ()
    r4: tuple = ()
    covers: str = ""
    doc: str = field(default="")


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, r2=(), r4=(), covers: str = ""):
    def deco(fn: Callable[[Context], DataFrame]):
        REGISTRY[name] = Query(name, fn, sql, tuple(r2), tuple(r4), covers, (fn.__doc__ or "").strip())
        return fn
    return deco


def finish(df: DataFrame, q: Query) -> DataFrame:
    rounds = {c: round_half_up(c, 2) for c in q.r2}
    rounds.update({c: round_half_up(c, 4) for c in q.r4})
    return df.withColumns(rounds) if rounds else df


_CONTEXTS: dict = {}


def shared_context(spark: SparkSession, sf_dir: str, params: Params = Params()) -> Context:
    """One plan context per (Spark application, data directory, parameters).

    Stage outputs a context materializes (weekly features, customers,
    forecasts, risk) are then written once per session and read by every
    later query, as the original's views read the batch outputs.
    """
    where = (spark.sparkContext.applicationId, sf_dir, params)
    state = _input_state(spark, sf_dir)
    if where not in _CONTEXTS or _CONTEXTS[where][0] != state:
        _CONTEXTS[where] = (state, Context(spark, sf_dir, params))
    return _CONTEXTS[where][1]


def _input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the inputs: a context made from other files is not used again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found))


def run(name: str, spark: SparkSession, sf_dir: str, params: Params = Params(), fresh: bool = False) -> DataFrame:
    """Build query ``name``; ``fresh`` forces a new context (whole chain recomputed)."""
    q = REGISTRY[name]
    ctx = Context(spark, sf_dir, params) if fresh else shared_context(spark, sf_dir, params)
    return finish(q.build(ctx), q)


def wrap_sql(q: Query, ctes: list[tuple[str, str]]) -> str:
    body = q.sql.strip()
    # Same rule as ``round_half_up`` on the Spark side.
    rounds = [f'CAST(ROUND(CAST("{c}" AS DECIMAL(38, 9)), {n}) AS DOUBLE) AS "{c}"'
              for n, cs in ((2, q.r2), (4, q.r4)) for c in cs]
    if rounds:
        body = f"SELECT * REPLACE ({', '.join(rounds)})\nFROM (\n{body}\n) AS _q"
    with_clause = ",\n".join(f"{n} AS ({s}\n)" for n, s in ctes)
    return f"WITH RECURSIVE {with_clause}\n{body}"
