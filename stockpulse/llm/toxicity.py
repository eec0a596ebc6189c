"""Toxicity by a subsequence string-kernel support vector machine with Nystroem landmarks.

Two strings are alike if they share subsequences of three letters; a
subsequence counts ``DECAY ** span`` for the stretch it covers (at most
``MAX_SPAN`` letters), so gaps and inserted letters cost little.  Features are
explicit: the kernel is an inner product of sparse vectors (with marks at both
ends of a word), normalised and raised to ``POWER``.  Landmarks are words that stand out in toxic sample texts.  A sentence is described by its
words' largest kernel values with every landmark (values below ``FLOOR``
count as 0), mapped by the Nystroem factor of the landmarks' kernel matrix.  A
linear machine with squared hinge loss is trained on sentences: all of
untoxic texts, and of a toxic text those that look toxic so far (one at
least).  A text's margin is that of its worst sentence, made a probability by a logistic fit.

Learning uses a bounded sample: ``max_docs`` labelled texts a class are
expected, with at most ``SENTENCES`` sentences of each in training.  Scoring
reads the text column only, whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpulse.llm.common import code_points, in_slices, uniform, with_outputs
from stockpulse.session import materialize

DECAY, MAX_SPAN, FLOOR, POWER = 0.75, 6, 0.45, 2
FEATURE_BITS = 16
SENTENCES = 8
MAX_KNOWN = 600_000
SLICE_CHARS = 1 << 20
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")
SPACED = re.compile(r"(?<!\S)[^\W\d_](?:[ \t][^\W\d_](?!\S)){3,}")
NOT_LETTERS = re.compile(r"[\W\d_]+")


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, feature, weight) of all three-letter subsequences within ``MAX_SPAN`` letters."""
    codes = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    of = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    parts = []
    for j in range(1, MAX_SPAN - 1):
        for k in range(j + 1, MAX_SPAN):
            i = np.arange(max(0, len(codes) - k))
            i = i[of[i] == of[i + k]]
            h = codes[i] * np.uint32(2654435761) ^ codes[i + j] * np.uint32(2246822519) ^ codes[i + k] * np.uint32(3266489917)
            h = (h ^ (h >> np.uint32(15))) * np.uint32(668265263)
            parts.append((of[i], (h >> np.uint32(32 - FEATURE_BITS)).astype(np.int64), np.full(len(i), DECAY ** (k + 1))))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _vectors(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same with equal features of a word summed and every word's vector at length 1."""
    of, f, w = subsequences(words)
    pairs, where = np.unique(of << FEATURE_BITS | f, return_inverse=True)
    w = np.bincount(where, weights=w, minlength=len(pairs))
    of, f = pairs >> FEATURE_BITS, pairs & ((1 << FEATURE_BITS) - 1)
    norm = np.sqrt(np.bincount(of, weights=w * w, minlength=len(words)))
    return of, f, w / norm[of]


class Kernel:
    """Kernel values of words with fixed landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        of, f, w = _vectors(landmarks)
        order = np.argsort(f, kind="stable")
        # inverted lists: for every feature the landmarks that have it, with their weights
        self.owner, self.weight = of[order], w[order]
        self.begin = np.searchsorted(f[order], np.arange((1 << FEATURE_BITS) + 1))
        self.largest = np.zeros(1 << FEATURE_BITS)
        np.maximum.at(self.largest, f, w)
        self.near: dict[str, np.ndarray] = {}  # tokens that resemble a landmark
        self.far: set[str] = set()             # tokens that don't

    def values(self, words: list[str]) -> np.ndarray:
        of, f, w = _vectors(words)
        shared = self.largest[f] > 0
        of, f, w = of[shared], f[shared], w[shared]
        size = self.begin[f + 1] - self.begin[f]
        at = np.repeat(self.begin[f] - np.cumsum(size) + size, size) + np.arange(size.sum())
        m = len(self.landmarks)
        out = np.bincount(np.repeat(of, size) * m + self.owner[at], weights=np.repeat(w, size) * self.weight[at], minlength=len(words) * m)
        out = out.reshape(len(words), m).astype(np.float32)
        return np.where(out >= FLOOR, out, 0) ** POWER

    def learn(self, tokens: list[str]) -> None:
        """Remember which tokens resemble a landmark, with their values."""
        if len(self.far) + len(self.near) > MAX_KNOWN:
            self.far.clear()
            self.near.clear()
        self.far.update(tokens)
        owner, words = [], []
        for t in tokens:
            if t.isalpha():
                parts = (t,)
            else:
                parts = [p for p in NOT_LETTERS.split(t) if p]
                parts = {"".join(parts), *parts}
            for w in parts:
                if len(w) >= 3:
                    owner.append(t)
                    words.append(w)
        for lo in range(0, len(words), 20_000):  # bounds the features held at once
            self._compare(owner[lo:lo + 20_000], words[lo:lo + 20_000])

    def _compare(self, owner: list[str], words: list[str]) -> None:
        # no kernel value exceeds this bound, which rules most words out with one number a feature
        of, f, w = subsequences(words)
        top = np.bincount(of, weights=w * self.largest[f], minlength=len(words))
        close = np.flatnonzero(top >= FLOOR * np.sqrt(np.bincount(of, weights=w * w, minlength=len(words))) - 1e-6)
        for lo in range(0, len(close), 2_000):
            some = close[lo:lo + 2_000]
            for i, v in zip(some, self.values([words[i] for i in some])):
                if v.any():
                    t = owner[i]
                    self.near[t] = np.maximum(v, self.near[t]) if t in self.near else v
                    self.far.discard(t)

    def sentences(self, texts: list[str]) -> list[np.ndarray]:
        """For every text, a row for each sentence with a word near a landmark: its words' largest kernel values."""
        out = [np.zeros((0, len(self.landmarks)), np.float32)] * len(texts)
        for a, b in in_slices(texts, SLICE_CHARS):
            some = [t.lower() for t in texts[a:b]]
            for i in spaced_out(some):
                some[i] = SPACED.sub(lambda m: re.sub(r"\s", "", m[0]), some[i])
            tokens = [set(t.split()) for t in some]
            new = set().union(*tokens) - self.far - self.near.keys()
            if len(self.far) + len(self.near) + len(new) > MAX_KNOWN:
                self.far.clear()
                self.near.clear()
                new = set().union(*tokens)
            self.learn(sorted(new))
            for i, (t, own) in enumerate(zip(some, tokens)):
                if self.near.keys().isdisjoint(own):
                    continue
                rows = []
                for s in SENTENCE.split(t):
                    hits = [v for v in map(self.near.get, s.split()) if v is not None]
                    if hits:
                        rows.append(np.max(hits, axis=0))
                if rows:
                    out[a + i] = np.array(rows, np.float32)
        return out


def spaced_out(texts: list[str]) -> list[int]:
    """Numbers of the texts with three single characters in a row between white space."""
    codes = code_points("\n".join(texts))
    blank = (codes <= 32) & (codes > 0)
    at = np.flatnonzero(blank[:-6] & blank[2:-4] & blank[4:-2] & blank[6:] & ~blank[1:-5] & ~blank[3:-3] & ~blank[5:-1]) if len(codes) > 6 else ()
    # four letters in a row have three with blanks on both sides, unless they begin or end the text
    ends = np.cumsum([len(t) + 1 for t in texts])
    found = set(np.searchsorted(ends, at, side="right").tolist())
    return sorted(found | {i for i, t in enumerate(texts) if len(t) < 12 or SPACED.match(t) or SPACED.search(t, max(0, len(t) - 9))})


@dataclass(frozen=True)
class ToxicityModel:
    """``weights`` work on the landmarks' kernel values (the Nystroem factor is multiplied in)."""

    landmarks: tuple[str, ...]
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -40, 40)))


def _svm(x: np.ndarray, y: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Weights (bias last, hardly penalised) of the squared-hinge machine, by Newton steps on the active rows."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(x.shape[1]), np.diag([1.0] * (x.shape[1] - 1) + [1e-3])
    loss = lambda w: 0.5 * w @ ridge @ w + (c * np.maximum(0, 1 - y * (x @ w)) ** 2).sum()
    for _ in range(50):
        on = y * (x @ w) < 1
        a = x[on] * c[on, None]
        grad = ridge @ w - 2 * a.T @ (y[on] - x[on] @ w)
        step = np.linalg.solve(ridge + 2 * a.T @ x[on], grad)
        rate = 1.0
        while rate > 1e-4 and loss(w - rate * step) > loss(w) - 1e-4 * rate * grad @ step:
            rate /= 2
        w = w - rate * step
        if np.abs(rate * step).max() < 1e-6:
            break
    return w


def _logistic(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(toxic | margin); targets are drawn in a little."""
    n1, n0 = y.sum(), (~y).sum()
    t = np.where(y, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.full(len(y), 1 / len(y))
    a = np.array([1.0, 0.0])
    x = np.stack([m, np.ones_like(m)], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -40, 40)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (weight * (p - t)) + 1e-6 * a)
        a = a - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(a[0]), float(a[1])


def train_machine(names: list[str], bags: list[np.ndarray], y: np.ndarray, cost: float) -> ToxicityModel:
    """The machine for sentences' kernel values with the landmarks (one array a text), and each text's class."""
    gram = Kernel(names).values(names).astype(np.float64)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    factor = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 0.05))) @ vectors.T
    x = [b @ factor for b in bags]
    used = [np.ones(len(b), bool) for b in x]
    for _ in range(6):  # the machine, and the sentences that make the toxic texts toxic, in turn
        rows = [b[u] for b, u in zip(x, used)]
        size = np.array([len(r) for r in rows])
        w = _svm(np.concatenate(rows), np.repeat(np.where(y, 1.0, -1.0), size), np.repeat(cost / np.sqrt(size), size))
        margin = [b @ w[:-1] + w[-1] for b in x]
        new = [(m > 0) | (m == m.max()) if toxic else u for m, u, toxic in zip(margin, used, y)]
        if all((n == u).all() for n, u in zip(new, used)):
            break
        used = new
    slope, offset = _logistic(np.array([(b @ w[:-1]).max() + w[-1] for b in x]), y)
    return ToxicityModel(tuple(names), factor @ w[:-1], float(w[-1]), slope, offset)


def fit_toxicity(docs: DataFrame, labels: DataFrame, train: Column | None = None, text: str = "text", key: str = "doc_id",
                 label: str = "toxic", max_docs: int = 2000, landmarks: int = 96, cost: float = 3.0, seed: int = 8) -> ToxicityModel:
    """Learn from the labelled rows that satisfy ``train`` (a condition on the key).

    Keys with conflicting labels, null keys and other labels than 0 and 1 are
    left out.  Without texts of both classes, or without a word that stands
    out, the model has no landmark and scores every text alike.
    """
    marked = labels.where(F.col(label).isin(0, 1))
    marked = marked.where(train) if train is not None else marked
    marked = (marked.groupBy(F.col(key).alias("_key")).agg(F.min(label).cast("int").alias("y"), F.max(label).cast("int").alias("other"))
              .where("_key is not null and y = other").select("_key", "y"))
    sizes = {r["y"]: r["count"] for r in marked.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return ToxicityModel((), np.zeros(0), 0.0, 1.0, 0.0)
    share = F.when(F.col("y") == 1, max_docs / sizes[1]).otherwise(max_docs / sizes[0])
    chosen = marked.where(uniform(F.lit(seed), F.col("_key")) < share)  # about 2 * max_docs keys
    sample = materialize(docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).where("text is not null")
                         .join(F.broadcast(chosen), "_key"), "toxicity-sample")

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(w, y) for t, y in zip(batch["text"], batch["y"])
                    for w in {w for token in set(t.lower().split()) for w in NOT_LETTERS.split(token) if 3 <= len(w) <= 30}]
            if rows:
                yield pd.DataFrame({"word": pd.Series([w for w, _ in rows], dtype=object), "y": [y for _, y in rows]})

    drawn = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    toxic, clean = drawn.get(1, 0), drawn.get(0, 0)
    counted = sample.select("text", "y").mapInPandas(words, "word string, y int").groupBy("word").agg(
        F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c"))
    odds = F.log(((F.col("t") + 0.5) / (toxic + 1)) / ((F.col("c") + 0.5) / (clean + 1)))
    # words seldom in untoxic texts, by how much of the toxic ones they explain
    picked = counted.where((F.col("t") >= 3) & (odds > 2)).orderBy(F.desc(F.col("t") * odds), "word").limit(landmarks).collect()
    if not picked or not clean:
        return ToxicityModel((), np.zeros(0), 0.0, 1.0, 0.0)
    names = [r["word"] for r in picked]

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kernel = Kernel(names)
        for batch in batches:
            rows = []
            for k, t, y in zip(batch["_key"], batch["text"], batch["y"]):
                found = np.unique(kernel.sentences([t])[0], axis=0)
                found = found[np.argsort(-found.max(axis=1), kind="stable")[:SENTENCES]] if len(found) else np.zeros((1, len(names)), np.float32)
                rows.append((str(k), y, found.tolist()))
            yield pd.DataFrame(rows, columns=["k", "y", "v"])

    bags = sorted(sample.mapInPandas(describe, "k string, y int, v array<array<float>>").collect(), key=lambda r: (r["k"], r["v"]))
    return train_machine(names, [np.array(r["v"]) for r in bags], np.array([r["y"] == 1 for r in bags]), cost)


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1), ``predicted`` (1 from 0.5 on) and ``n_suspect_sentences`` to every row.

    A null, empty or wordless text has the score of a text without any
    suspect word.  Rows are neither dropped nor joined; input columns named
    like an output are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the number of landmarks

    @F.pandas_udf("score double, n long")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        kernel = Kernel(list(m.landmarks)) if m.landmarks else None
        for batch in batches:
            margins, suspects = np.full(len(batch), m.bias), np.zeros(len(batch), np.int64)
            described = kernel.sentences([t if t is not None else "" for t in batch]) if kernel else ()
            for i, found in enumerate(described):
                if len(found):
                    margin = found @ m.weights + m.bias
                    margins[i], suspects[i] = margin.max(), (margin > 0).sum()
            yield pd.DataFrame({"score": m.probability(margins), "n": suspects})

    return with_outputs(docs.withColumn("_toxicity", score(F.col(text))), {
        "score": F.col("_toxicity.score"), "predicted": (F.col("_toxicity.score") >= 0.5).cast("int"),
        "n_suspect_sentences": F.col("_toxicity.n")}).drop("_toxicity")
