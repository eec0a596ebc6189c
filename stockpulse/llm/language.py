"""Language identification by multilingual mixture inference.

A document is taken as words drawn from a mixture of languages.  Each
language has letter-trigram likelihoods learned from labelled texts; a word's
likelihood under a language is the product over its trigrams.  Expectation
maximisation estimates the proportions of the languages in one document, and
the set of languages is the one of least penalised likelihood
(``-2 log L + penalty * |set| * log(words)``) among the nested sets of the
most frequent languages.

Training counts are gathered by Spark from a bounded random sample of
``max_docs_per_lang`` whole texts a language (the documented bound); the
model is one table of ``2**16 x languages`` floats, so what is sent to the
tasks does not grow with the corpus.  Prediction reads the text column only.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpulse.llm.common import category_table, code_points, in_slices, uniform, with_outputs

BUCKET_BITS = 16
TABLE_CELLS = 1 << 24      # of the model: buckets times languages
SLICE_CHARS = 1 << 20
UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageModel:
    langs: tuple[str, ...]
    log_p: np.ndarray  # languages x buckets, float32

    @property
    def bits(self) -> int:
        return self.log_p.shape[1].bit_length() - 1


def bucket_bits(languages: int) -> int:
    """Trigram buckets (as a power of two) that keep the table within ``TABLE_CELLS``: 2**16 up to 256 languages, fewer for more."""
    return min(BUCKET_BITS, max(6, (TABLE_CELLS // max(languages, 1)).bit_length() - 1))


def letter_trigrams(texts: list[str], bits: int = BUCKET_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram buckets of all letters, the index of each word's first letter, and each word's text number."""
    lowered = [t.lower() for t in texts]
    ends = np.cumsum([len(t) + 1 for t in lowered])
    codes = code_points("\n" + "\n".join(lowered) + "\n")
    letter = category_table()[codes] == 1
    codes = np.where(letter, codes, 0).astype(np.uint32)
    at = np.flatnonzero(letter)
    h = codes[at - 1] * np.uint32(2654435761) ^ codes[at] * np.uint32(2246822519) ^ codes[at + 1] * np.uint32(3266489917)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(668265263)
    first = np.flatnonzero(~letter[at - 1])
    return (h >> np.uint32(32 - bits)).astype(np.int32), first, np.searchsorted(ends, at[first] - 1, side="right")


def fit_language_model(docs: DataFrame, train: Column | None = None, text: str = "text", lang: str = "lang",
                       key: str = "doc_id", max_docs_per_lang: int = 1500, smoothing: float = 0.2,
                       seed: int = 7) -> LanguageModel:
    """Learn trigram likelihoods from labelled rows (``train``, non-null text and language).

    ``max_docs_per_lang`` whole texts a language are expected in the sample,
    drawn by a hash of the key.  Every language value is learned; with more
    than 256 of them trigrams share buckets (``bucket_bits``), so that the
    table stays bounded.  Without any labelled row the model knows no
    language, and every text is undetermined.
    """
    rows = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    rows = rows.where(train) if train is not None else rows
    sizes = rows.groupBy(F.col(lang).alias("lang")).count().collect()
    langs = tuple(sorted(r["lang"] for r in sizes))
    bits = bucket_bits(len(langs))
    if not langs:
        return LanguageModel((), np.zeros((0, 1 << bits), np.float32))
    shares = docs.sparkSession.createDataFrame([(r["lang"], max_docs_per_lang / r["count"]) for r in sizes], "_lang string, _share double")
    sample = (rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), uniform(F.lit(seed), F.col(key)).alias("u"))
              .join(F.broadcast(shares), F.col("lang") == F.col("_lang")).where("u < _share").select("lang", "text"))   # a row a language

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, part in batch.groupby("lang")["text"]:
                texts = part.tolist()
                for a, b in in_slices(texts, SLICE_CHARS):
                    n = np.bincount(letter_trigrams(texts[a:b], bits)[0], minlength=1 << bits)
                    total[name] = total[name] + n if name in total else n
        for name, n in total.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"lang": name, "bucket": at.astype(np.int32), "n": n[at].astype(np.int64)})

    counted = (sample.mapInPandas(count, "lang string, bucket int, n long")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
               .groupBy("lang").agg(F.collect_list("bucket").alias("bucket"), F.collect_list("n").alias("n")).collect())
    n = np.zeros((len(langs), 1 << bits))
    for r in counted:
        n[langs.index(r["lang"]), r["bucket"]] = r["n"]
    n += smoothing
    return LanguageModel(langs, np.log(n / n.sum(axis=1, keepdims=True)).astype(np.float32))


def _mixture(q: np.ndarray, starts: np.ndarray, n: np.ndarray, allowed: np.ndarray, rounds: int = 40, tol: float = 1e-3) -> np.ndarray:
    """EM proportions (documents x languages) with the languages of ``allowed`` alone.

    ``q``: words x languages, likelihoods scaled by the word's largest.
    """
    out = allowed / allowed.sum(axis=1, keepdims=True)
    live = np.arange(len(n))
    for _ in range(rounds):
        pi = out[live].astype(np.float32)
        resp = q * np.repeat(pi, n[live], axis=0)
        resp /= resp.sum(axis=1, keepdims=True) + 1e-30
        new = np.add.reduceat(resp, starts, axis=0) / n[live, None]
        out[live] = new
        moving = np.abs(new - pi).max(axis=1) > tol
        if not moving.any():
            break
        if moving.sum() < 0.7 * len(live):
            q = q[np.repeat(moving, n[live])]
            live = live[moving]
            starts = np.concatenate([[0], np.cumsum(n[live])[:-1]])
    return out


def _log_likelihood(q: np.ndarray, top: np.ndarray, starts: np.ndarray, n: np.ndarray, pi: np.ndarray) -> np.ndarray:
    p = (q * np.repeat(pi.astype(np.float32), n, axis=0)).sum(axis=1)
    return np.add.reduceat(top + np.log(p + 1e-30, dtype=np.float64), starts)


def infer(model: LanguageModel, texts: list[str], penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (texts x languages) in the selected sets, and the number of words; zero rows for texts without letters."""
    return infer_with_evidence(model, texts, penalty)[:2]


def infer_with_evidence(model: LanguageModel, texts: list[str], penalty: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``infer``, and the log likelihood of the text under its mixture over that under evenly spread trigrams."""
    out, words, evidence = np.zeros((len(texts), len(model.langs))), np.zeros(len(texts), np.int64), np.zeros(len(texts))
    for a, b in in_slices(texts, SLICE_CHARS):
        h, first, of = letter_trigrams(texts[a:b], model.bits)
        if not len(first) or not model.langs:
            continue
        ll = np.stack([np.add.reduceat(p[h], first) for p in model.log_p], axis=1)
        docs, starts, n = np.unique(of, return_index=True, return_counts=True)
        words[a + docs] = n
        top = ll.max(axis=1)
        q = np.exp(ll - top[:, None])
        full = _mixture(q, starts, n, np.ones((len(docs), len(model.langs))))
        order = np.argsort(-full, axis=1, kind="stable")
        single = np.add.reduceat(ll.astype(np.float64), starts, axis=0)
        cost, chosen = -2 * single.max(axis=1) + penalty * np.log(n + 1), np.zeros_like(full)
        chosen[np.arange(len(docs)), single.argmax(axis=1)] = 1
        # no set is likelier than the full one, which rules most documents out of a second language
        least = -2 * _log_likelihood(q, top.astype(np.float64), starts, n, full)
        for size in range(2, len(model.langs) + 1):
            open_ = np.flatnonzero(least + size * penalty * np.log(n + 1) < cost)
            if not len(open_):
                break
            pick = np.zeros(len(docs), bool)
            pick[open_] = True
            own = np.repeat(pick, n)
            sub_n = n[open_]
            sub_starts = np.concatenate([[0], np.cumsum(sub_n)[:-1]])
            allowed = np.zeros((len(open_), len(model.langs)))
            np.put_along_axis(allowed, order[open_, :size], 1, axis=1)
            pi = _mixture(q[own], sub_starts, sub_n, allowed)
            now = -2 * _log_likelihood(q[own], top[own].astype(np.float64), sub_starts, sub_n, pi) + size * penalty * np.log(sub_n + 1)
            better = now < cost[open_]
            cost[open_[better]], chosen[open_[better]] = now[better], pi[better]
        out[a + docs] = chosen
        likelihood = (penalty * np.log(n + 1) * np.maximum((chosen > 0).sum(axis=1), 1) - cost) / 2
        letters = np.add.reduceat(np.diff(np.append(first, len(h))), starts)
        evidence[a + docs] = likelihood + letters * model.bits * np.log(2)
    return out, words, evidence


def identify_languages(docs: DataFrame, model: LanguageModel, text: str = "text", penalty: float = 12.0) -> DataFrame:
    """Add ``lang_pred``, ``score``, ``languages``, ``proportions`` and ``evidence`` to every row.

    ``score`` is the proportion of the predicted language in the selected
    mixture; ``languages`` and ``proportions`` list the set by falling share;
    ``evidence`` is the log of how much likelier the text is under its mixture
    than with evenly spread trigrams.
    A null text, a text without letters, or a model without languages gives
    ``und``, 0.0, empty lists and no evidence (0.0).  Ties go to the language first in the
    alphabet.  Rows are neither dropped nor joined, so repeated rows, null
    keys and empty tables need no care; input columns named like an output
    are replaced.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)  # bounded: TABLE_CELLS floats

    @F.pandas_udf("lang_pred string, score double, languages array<string>, proportions array<double>, evidence double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = known.value
        for batch in batches:
            texts = [t if t is not None else "" for t in batch]
            pi, words, evidence = infer_with_evidence(m, texts, penalty)
            rows = []
            for p, n, e in zip(pi, words, evidence):
                if not n or not m.langs:
                    rows.append((UNDETERMINED, 0.0, [], [], 0.0))
                    continue
                at = [int(i) for i in np.argsort(-p, kind="stable") if p[i] > 0]
                rows.append((m.langs[at[0]], min(1.0, float(p[at[0]])), [m.langs[i] for i in at], [float(p[i]) for i in at], float(e)))
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "languages", "proportions", "evidence"])

    # the inferred mixture is one column, so that Spark evaluates it once a row
    marked = docs.withColumn("_mixture", predict(F.col(text)))
    return with_outputs(marked, {c: F.col("_mixture")[c] for c in ("lang_pred", "score", "languages", "proportions", "evidence")}).drop("_mixture")


def keep_identified(docs: DataFrame, model: LanguageModel, least_evidence: float = -20.0, **kwargs) -> DataFrame:
    """Rows whose text has letters and is not worse explained by its languages than by chance, with the input's columns.

    A text goes if evenly spread trigrams are likelier than its mixture by a
    factor of ``exp(-least_evidence)``, which a short text can't reach; how
    many languages it mixes plays no part.  Null texts and texts without
    letters go, repeated rows all stay or all go, an empty table stays empty,
    and if no language is known every row goes.
    """
    # columns by number, so that none is named like an output and no text is carried twice while its row waits for Python
    text = [c.lower() for c in docs.columns].index(kwargs.pop("text", "text").lower())
    numbered = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])
    found = identify_languages(numbered, model, text=f"_{text}", **kwargs).where((F.col("lang_pred") != UNDETERMINED) & (F.col("evidence") >= least_evidence))
    return found.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])
