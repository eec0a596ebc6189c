"""Whitening against plain numpy on exact integers."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from stockpulse.llm import queries, whitening

SF = "/root/testdata/sf0.01"
KIND = "vec_id long, embedding array<float>, whitened string, deviation int"


def frame(spark, vectors, kind="float"):
    return spark.createDataFrame(list(enumerate(vectors)), f"vec_id long, embedding array<{kind}>").repartition(3)


def exact_covariance(x):
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    return s, [[Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n**3) for j in range(d)] for i in range(d)]


@pytest.mark.parametrize("scale,kind", [(1.0, "float"), (1e7, "double"), (1e14, "double")])
def test_covariance_is_exact(spark, scale, kind):
    rng = random.Random(2)
    vectors = [[rng.gauss(0.3 * i, 1 + i) * scale for i in range(5)] for _ in range(60)]
    kept, model = whitening.fit_whitening(frame(spark, vectors, kind))
    x = [[math.floor(64 * c) + 1_000_000 for c in r["embedding"]] for r in kept.collect()]
    sums, want = exact_covariance(x)
    assert model.n == 60 and model.sums == sums
    assert all(model.covariance[i][j] == float(want[i][j]) for i in range(5) for j in range(5))
    got = {r["vec_id"]: r for r in whitening.whiten(kept, model).collect()}
    for r, row in zip(kept.collect(), x):
        assert int(got[r["vec_id"]]["deviation"]) == sum((60 * v - s) ** 2 for v, s in zip(row, sums))
    assert model.identity_error < 1e-9


def test_query_against_numpy(spark):
    rows = queries.QUERIES["op12_polarised_whitening"](spark, SF).collect()
    table = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    ids = sorted(table)
    x = np.floor(64 * np.array([table[i] for i in ids], np.float64)).astype(np.int64) + 1_000_000
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    w = (x - x.mean(0)) @ vectors[:, :32] / np.sqrt(values[:32])
    got = np.zeros((len(ids), 32))
    place = {k: i for i, k in enumerate(ids)}
    n, s = len(x), x.sum(0)
    deviation = ((n * x - s) ** 2).sum(1)
    assert len(rows) == 32 * n
    for r in rows:
        got[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == deviation[place[r["vec_id"]]] and r["identity_error"] < 1e-4
        assert abs(r["explained"] - values[r["component"] - 1] / values.sum()) <= 1e-9
    sign = np.sign((got * w).sum(0))
    assert np.abs(got * sign - w).max() < 1e-6
    assert np.abs(np.cov(got.T, bias=True) - np.eye(32)).max() < 1e-9


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0, 2.0], "x", 1), (1, [0.5, 1.0, 2.0], "x", 1), (2, [1.5, -1.0, 2.0], None, None), (None, [0.25, 3.0, 2.0], "y", 2), (3, None, "z", 3),
            (4, [], "z", 3), (5, [1.0, None, 2.0], "z", 3), (6, [1.0, nan, 2.0], "z", 3), (7, [1.0, 2.0, -inf], "z", 3), (8, [1.0, 2.0], "z", 3)]
    df = spark.createDataFrame(rows, KIND)
    kept, model = whitening.fit_whitening(df)
    assert model.n == 4 and model.dims == 3 and len(model.values) == 2   # the third dimension never changes
    done = whitening.whiten(kept, model)
    assert done.columns == ["vec_id", "embedding", "deviation", "whitened"]
    assert sorted(str(r["vec_id"]) for r in done.collect()) == ["1", "1", "2", "None"]
    assert abs(sum(r["whitened"][0] for r in done.collect())) < 1e-9
    for nothing in (df.limit(0), df.where("vec_id = 3"), df.where("vec_id = 1")):
        assert whitening.fit_whitening(nothing)[1] is None
    kept, model = whitening.fit_whitening(spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])], "vec_id long, embedding array<double>"))
    assert model.n == 3 and len(whitening.whiten(kept, model).collect()) == 3
