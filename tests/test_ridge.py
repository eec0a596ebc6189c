"""Ridge from sufficient statistics against plain numpy on all rows."""

import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from stockpulse.operators import forecast as fc
from stockpulse.operators.ridge import RidgeModel, RidgeStatistics, sufficient_statistics
from stockpulse.plans.context import Context
from stockpulse.session import materialize

NUMERIC, CATEGORICAL = ["x", "level", "far"], ["c", "d"]


def rows(n=400, seed=3):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        c, d = f"c{int(rng.zipf(1.6)) % 40}", f"d{i % 3}"
        x = float(rng.normal())
        out.append((x, 2.0, float(1e7 + rng.normal()), c, d, 3 * x + len(c) + (d == "d1") + float(rng.normal()) * 0.1, i % 10 == 9))
    return out


def frame(spark, parts):
    return spark.createDataFrame(rows(), "x double, level double, far double, c string, d string, units_sold double, test boolean").repartition(parts)


def plain(data, alpha=2.5, least=5):
    """Weights by name, and the intercept, from the rows themselves."""
    y = np.array([r[5] for r in data])
    columns = {}
    for i, name in enumerate(NUMERIC):
        v = np.array([r[i] for r in data])
        s = v.std() if v.max() > v.min() else 1.0
        columns[name] = (v - v.mean()) / s
    for i, name in ((3, "c"), (4, "d")):
        v = [r[i] for r in data]
        kept = sorted({x for x in v if v.count(x) >= least})
        for label in kept:
            columns[name, label] = np.array([x == label for x in v], float)
        if len(kept) < len(set(v)):
            columns[name, None] = np.array([x not in kept for x in v], float)
    z = np.stack(list(columns.values()), 1)
    zc = z - z.mean(0)
    w = np.linalg.solve(zc.T @ zc + alpha * np.eye(z.shape[1]), zc.T @ (y - y.mean()))
    return dict(zip(columns, w)), y.mean() - z.mean(0) @ w


@pytest.mark.parametrize("parts", [1, 8, 64, 200])
def test_both_fits_equal_plain_ridge_for_any_partitions(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", min(parts, 64))
    try:
        found = sufficient_statistics(frame(spark, parts), NUMERIC, CATEGORICAL, "units_sold", F.col("test"))
        stats = RidgeStatistics(found, NUMERIC, CATEGORICAL, 5)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for fit, data in (("train", [r for r in rows() if not r[6]]), ("all", rows())):
        m = RidgeModel(NUMERIC, CATEGORICAL).solve(stats, fit)
        weights, intercept = plain(data)
        assert m.scales["level"] == 1.0 and m.means["level"] == 2.0 and m.rows == len(data)
        assert m.has_pooled["c"] and not m.has_pooled["d"]
        got = {**m.weights, **m.label_weights}
        assert got.keys() == weights.keys()
        assert all(abs(got[k] - weights[k]) < 1e-7 for k in got) and abs(m.intercept - intercept) < 1e-7


def test_predictions_know_rare_and_unseen_labels(spark):
    train = frame(spark, 4)
    m = RidgeModel(NUMERIC, CATEGORICAL).fit(train)
    weights, intercept = plain(rows())
    rare = next(r["label"] for r in m.vocabulary().where("pooled").collect())
    asked = spark.createDataFrame([(1, 0.5, 2.0, 1e7, rare, "d1"), (2, 0.5, 2.0, 1e7, "never", "d1"), (3, 0.5, 2.0, 1e7, m.frequent["c"][0], None)],
                                  "id int, x double, level double, far double, c string, d string")
    got = {r["id"]: r["p"] for r in m.predict(asked, "p", clipped=False).collect()}
    base = m.intercept + weights["x"] * (0.5 - m.means["x"]) / m.scales["x"] + weights["far"] * (1e7 - m.means["far"]) / m.scales["far"]
    assert abs(got[1] - (base + weights["c", None] + weights["d", "d1"])) < 1e-6
    assert abs(got[2] - (base + weights["d", "d1"])) < 1e-6
    assert abs(got[3] - (base + weights["c", m.frequent["c"][0]])) < 1e-6


def test_fits_read_the_rows_once(spark, tmp_path):
    """Both fits are solved after the rows are gone: the statistics of one pass hold all they need."""
    path = str(tmp_path / "rows")
    frame(spark, 3).write.parquet(path)
    found = sufficient_statistics(spark.read.parquet(path), NUMERIC, CATEGORICAL, "units_sold", F.col("test"))
    shutil.rmtree(path)
    stats = RidgeStatistics(found, NUMERIC, CATEGORICAL, 5)
    assert all(RidgeModel(NUMERIC, CATEGORICAL).solve(stats, fit).rows for fit in ("train", "all"))


def test_whole_run_equals_numpy(spark):
    weekly = materialize(Context(spark, SF0001).weekly)
    run = fc.ridge_run(weekly)
    data = fc.prepare(weekly).toPandas()
    last = data["week_start"].max()
    train = data[[(last - w).days >= 7 * 8 for w in data["week_start"]]]

    def fit(part):
        z, names = [], []
        for c in fc.NUMERIC_FEATURES:
            v = part[c].to_numpy(float)
            s = v.std() if v.max() > v.min() else 1.0
            z.append((v - v.mean()) / s)
            names.append((c, v.mean(), s))
        for c in fc.CATEGORICAL_FEATURES:
            n = part[c].value_counts()
            for label in sorted(n[n >= 5].index):
                z.append((part[c] == label).to_numpy(float))
                names.append((c, label, None))
            if (n < 5).any():
                z.append(part[c].isin(n[n < 5].index).to_numpy(float))
                names.append((c, set(n[n < 5].index), None))
        z, y = np.stack(z, 1), part["units_sold"].to_numpy(float)
        zc = z - z.mean(0)
        w = np.linalg.solve(zc.T @ zc + 2.5 * np.eye(z.shape[1]), zc.T @ (y - y.mean()))
        return names, w, y.mean() - z.mean(0) @ w

    def predict(fitted, part):
        names, w, b = fitted
        out = np.full(len(part), b)
        for (c, m, s), k in zip(names, w):
            out += k * ((part[c].to_numpy(float) - m) / s if s is not None else part[c].isin(m if isinstance(m, set) else [m]).to_numpy(float))
        return np.maximum(out, 0)

    test = data[[(last - w).days < 7 * 8 for w in data["week_start"]]]
    want = dict(zip(zip(test["sku_id"], test["week_start"]), predict(fit(train), test)))
    got = {(r["sku_id"], r["week_start"]): r["model_forecast"] for r in run["backtest"].collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in got) < 1e-6
    future = fc.future_frame(fc.prepare(weekly), 8).toPandas()
    want = dict(zip(zip(future["sku_id"], future["week_start"]), predict(fit(data), future)))
    got = {(r["sku_id"], r["week_start"]): r["forecast_units"] for r in run["forecasts"].collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in got) < 1e-6
