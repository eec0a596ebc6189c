"""Ridge regression from sufficient statistics.

One pass over the rows gives, for the train and the test weeks apart, the
count, sums, ranges and cross products of all numeric features and the target
(a block of the Gram matrix), the sums by category label, and the counts of
label pairs.  All are sums that combine before the shuffle, in generated code;
the result has a row for each feature, label and pair of labels, whatever the
number of rows.  What
holds for all weeks follows by adding the two sides up, so both fits are
solved from the same scan.

Rare labels are pooled inside Spark: only the equations' own coefficients
(features and frequent labels) come to the driver.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpulse.session import materialize

MAX_FEATURES = 4_000        # columns of the dense equations that the driver solves
CENTRE_ROWS = 1_000         # rows whose mean is the provisional centre
FITS = ("train", "all")


def sufficient_statistics(rows: DataFrame, numeric: list[str], categorical: list[str], target: str,
                          is_test: Column | None = None) -> tuple[DataFrame, list[float]]:
    """The written statistics, and the centre they were taken about.

    A row has (``is_test``, ``a``, ``va``, ``b``, ``vb``, ``n``, ``lo``,
    ``hi``, ``sums``); ``a`` numbers the numeric features, the target and the
    categorical features, in this order.  ``sums`` are, for all numeric
    features and the target, the sums of their centred values: over all rows
    (``a`` is -1), over the rows of a label (``va``) or of two labels
    (``b``, ``vb``), and times a numeric feature's own centred value.

    The centre is the mean of a few rows; it takes away most of what would
    cancel, and the rest of the mean goes in ``RidgeStatistics``.
    """
    z = [*numeric, target]
    few = rows.select(*[F.col(f"`{c}`").cast("double").alias(f"z{j}") for j, c in enumerate(z)]).limit(CENTRE_ROWS)
    centre = [float(v or 0.0) for v in few.agg(*[F.avg(f"z{j}") for j in range(len(z))]).first()]
    none, nothing = F.lit(None).cast("string"), F.lit(-1)
    label = [F.col(f"`{c}`").cast("string") for c in categorical]
    value = [F.col(f"`{c}`").cast("double") for c in z]

    def part(a: int, va: Column, b: Column, vb: Column, x: Column, raw: Column) -> Column:
        return F.struct(F.lit(a).alias("a"), va.alias("va"), b.alias("b"), vb.alias("vb"), x.alias("x"), raw.alias("raw"))

    one, no = F.lit(1.0), F.lit(None).cast("double")
    parts = [part(-1, none, nothing, none, one, no)]
    parts += [part(i, none, nothing, none, v - F.lit(m), v) for i, (v, m) in enumerate(zip(value, centre))]
    parts += [part(len(z) + i, v, nothing, none, one, no) for i, v in enumerate(label)]
    parts += [part(len(z) + i, label[i], F.lit(len(z) + j), label[j], one, no) for i, j in itertools.combinations(range(len(label)), 2)]
    side = F.lit(False) if is_test is None else is_test
    each = rows.select(side.alias("is_test"), *[(v - F.lit(m)).alias(f"z{j}") for j, (v, m) in enumerate(zip(value, centre))], F.explode(F.array(*parts)).alias("p"))
    sums = each.groupBy("is_test", "p.a", "p.va", "p.b", "p.vb").agg(
        F.count(F.lit(1)).alias("n"), F.min("p.raw").alias("lo"), F.max("p.raw").alias("hi"), *[F.sum(F.col("p.x") * F.col(f"z{j}")).alias(f"s{j}") for j in range(len(z))])
    table = materialize(sums.select("is_test", "a", "va", "b", "vb", "n", "lo", "hi", F.array(*[f"s{j}" for j in range(len(z))]).alias("sums")), "ridge-statistics")
    return table, centre


class RidgeStatistics:
    """What the fits need on the driver, read from the written statistics in three small aggregates."""

    def __init__(self, statistics: tuple[DataFrame, list[float]], numeric: list[str], categorical: list[str], min_frequency: int):
        table, centre = statistics
        self.centre = np.array(centre)
        self.table, self.numeric, self.categorical, self.min_frequency = table, list(numeric), list(categorical), min_frequency
        self.width = len(self.numeric) + 1
        fit = F.explode(F.when(F.col("is_test"), F.array(F.lit("all"))).otherwise(F.array(*map(F.lit, FITS)))).alias("fit")
        # every label of a fit with its count, and whether it is pooled
        by_label = table.where((F.col("b") < 0) & (F.col("a") >= self.width)).select(fit, "a", "va", "n", "sums")
        means = [F.sum(F.get("sums", F.lit(j))) for j in range(self.width)]
        self.labels = by_label.groupBy("fit", "a", "va").agg(F.sum("n").alias("n"), F.array(*means).alias("sums")).withColumn("pooled", F.col("n") < min_frequency)
        kept = F.when(~F.col("pooled"), F.col("va")).alias("label")
        rows = self.labels.groupBy("fit", "a", "pooled", kept).agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(j))) for j in range(self.width)]).alias("sums"), F.count(F.lit(1)).alias("labels"))
        found = rows.limit(len(FITS) * (MAX_FEATURES + 1)).collect()
        for f in FITS:
            if sum(r["fit"] == f for r in found) + len(self.numeric) > MAX_FEATURES:
                raise ValueError(f"the normal equations take {MAX_FEATURES} features at most; raise one_hot_min_frequency or coarsen the categories")
        self.found = found
        flags = self.labels.select("fit", "a", "va", kept)
        pairs = table.where(F.col("b") >= 0).select(fit, "a", "va", "b", "vb", "n")
        pairs = (pairs.join(flags.withColumnRenamed("label", "la"), ["fit", "a", "va"])
                 .join(flags.select("fit", F.col("a").alias("b"), F.col("va").alias("vb"), F.col("label").alias("lb")), ["fit", "b", "vb"]))
        self.pairs = pairs.groupBy("fit", "a", "la", "b", "lb").agg(F.sum("n").alias("n")).collect()
        self.sides = {}
        for r in table.where(F.col("a") < self.width).orderBy("is_test", "a").collect():
            self.sides.setdefault(r["is_test"], []).append(r)

    def moments(self, fit: str) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
        """Count, means about the centre, centred cross products and whether constant, of the numeric features and the target."""
        n, first, products = 0, np.zeros(self.width), np.zeros((self.width, self.width))
        lo, hi = np.full(self.width, np.inf), np.full(self.width, -np.inf)
        for test in (False, True)[:1 if fit == "train" else 2]:
            rows = self.sides.get(test)
            if rows:
                n += rows[0]["n"]
                first += np.array(rows[0]["sums"])
                products += np.array([r["sums"] for r in rows[1:]])
                lo, hi = np.minimum(lo, [r["lo"] for r in rows[1:]]), np.maximum(hi, [r["hi"] for r in rows[1:]])
        shift = first / max(n, 1)
        products -= np.outer(first, shift)
        constant = lo >= hi
        shift = np.where(constant & np.isfinite(lo), lo - self.centre, shift)
        products[constant, :] = products[:, constant] = 0.0
        return n, shift, (products + products.T) / 2, constant


class RidgeModel:
    """Standard scaling (population deviation) and one-hot labels with rare ones pooled; closed-form ridge."""

    INFREQUENT = "__infrequent__"

    def __init__(self, numeric: list[str], categorical: list[str], alpha: float = 2.5, min_frequency: int = 5, target: str = "units_sold"):
        self.numeric, self.categorical = list(numeric), list(categorical)
        self.alpha, self.min_frequency, self.target = alpha, min_frequency, target

    def fit(self, train: DataFrame) -> "RidgeModel":
        """Fit on all rows of one frame."""
        found = sufficient_statistics(train, self.numeric, self.categorical, self.target)
        return self.solve(RidgeStatistics(found, self.numeric, self.categorical, self.min_frequency), "train")

    def solve(self, stats: RidgeStatistics, fit: str) -> "RidgeModel":
        """The normal equations of one fit, from statistics of all rows."""
        self.statistics, self.fitted = stats, fit
        n, shift, products, constant = stats.moments(fit)
        p, mean = len(self.numeric), stats.centre + shift
        deviation = np.sqrt(np.maximum(np.diag(products), 0.0) / max(n, 1))
        scale = np.where(constant | (deviation == 0), 1.0, deviation)
        self.rows = n
        self.means = dict(zip(self.numeric, map(float, mean)))
        self.scales = dict(zip(self.numeric, map(float, scale)))
        rows = sorted((r for r in stats.found if r["fit"] == fit), key=lambda r: (r["a"], r["pooled"], r["label"] or ""))
        self.frequent = {c: [r["label"] for r in rows if r["a"] == stats.width + i and not r["pooled"]] for i, c in enumerate(self.categorical)}
        self.has_pooled = {c: any(r["a"] == stats.width + i and r["pooled"] for r in rows) for i, c in enumerate(self.categorical)}
        place = {(r["a"], r["label"]): p + k for k, r in enumerate(rows)}
        size = p + len(rows)
        gram, right = np.zeros((size, size)), np.zeros(size)
        gram[:p, :p] = products[:p, :p] / np.outer(scale[:p], scale[:p])
        right[:p] = products[:p, p] / scale[:p]
        counts = np.array([r["n"] for r in rows], float)
        for k, r in enumerate(rows):
            about = np.where(constant, 0.0, np.array(r["sums"]) - r["n"] * shift)
            gram[p + k, :p] = gram[:p, p + k] = about[:p] / scale[:p]
            right[p + k] = about[p]
        if rows:
            gram[p:, p:] = np.diag(counts) - np.outer(counts, counts) / n
        for r in stats.pairs:
            if r["fit"] == fit:
                i, j = place[r["a"], r["la"]], place[r["b"], r["lb"]]
                gram[i, j] += r["n"]
                gram[j, i] += r["n"]
        self.gram = gram
        if self.alpha > 0:
            solved = np.linalg.solve(gram + self.alpha * np.eye(size), right)
        else:   # labels of one feature add up to a constant, so the equations are singular: the shortest solution
            solved = np.linalg.lstsq(gram, right, rcond=None)[0]
        self.weights = {self.numeric[i]: float(solved[i]) for i in range(p)}
        self.label_weights = {(self.categorical[r["a"] - stats.width], r["label"]): float(solved[p + k]) for k, r in enumerate(rows)}
        self.intercept = float(mean[p] - (solved[p:] @ counts) / max(n, 1))
        return self

    def labels(self, c: str) -> list[str]:
        """The labels with a weight of their own, in order, and the name of the pool if there is one."""
        return self.frequent[c] + [self.INFREQUENT] * self.has_pooled[c]

    def vocabulary(self) -> DataFrame:
        """(``feature``, ``label``, ``pooled``) of every label seen."""
        names = F.array(*[F.lit(c) for c in self.categorical])
        return self.statistics.labels.where(F.col("fit") == self.fitted).select(
            F.get(names, F.col("a") - self.statistics.width).alias("feature"), F.col("va").alias("label"), "pooled")

    def coefficients(self) -> tuple[float, list[float]]:
        """Intercept, and weights: numeric features, then for each category its labels and a zero for labels not seen."""
        out = [self.weights[c] for c in self.numeric]
        for c in self.categorical:
            out += [self.label_weights[c, None if v == self.INFREQUENT else v] for v in self.labels(c)] + [0.0]
        return self.intercept, out

    def predict(self, df: DataFrame, out_col: str = "prediction", clipped: bool = True) -> DataFrame:
        """the row's own prediction, clipped at zero.

        Label weights come by joins with the label table, so that neither
        many labels nor many pooled ones matter; a label not seen weighs
        nothing.
        """
        spark = df.sparkSession
        value = F.lit(self.intercept)
        for c in self.numeric:
            value = value + F.lit(self.weights[c]) * (F.col(f"`{c}`").cast("double") - F.lit(self.means[c])) / F.lit(self.scales[c])
        names = df.columns
        for i, c in enumerate(self.categorical):
            known = spark.createDataFrame([(v, self.label_weights[c, v]) for v in self.frequent[c]], f"_v{i} string, _w{i} double")
            if self.has_pooled[c]:
                rare = self.vocabulary().where((F.col("feature") == c) & F.col("pooled"))
                known = known.unionAll(rare.select("label", F.lit(self.label_weights[c, None])))
            df = df.join(known, F.col(f"`{c}`").cast("string") == F.col(f"_v{i}"), "left")
            value = value + F.coalesce(F.col(f"_w{i}"), F.lit(0.0))
        value = F.greatest(value, F.lit(0.0)) if clipped else value
        return df.select(*[F.col(f"`{n}`") for n in names if n != out_col], value.alias(out_col))
