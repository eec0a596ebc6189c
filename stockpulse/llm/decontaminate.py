"""Benchmark decontamination: every passage of the corpus queries a BM25 index of the test items.

The index is inverted, sparse and made by Spark: items give (term, item)
rows, document frequencies, the mean length and the norms of impacts are
aggregates over all items, whatever is searched at once.  Impacts are BM25
weights divided by the item's score for its own text, so that 1 means "all of
its words" for every item and one threshold serves all.

Items are dealt into passes of bounded bytes.  A pass orders its items by
length and cuts them into blocks; a term's list carries the largest impact of
each block.  A passage is skipped when its terms' largest impacts stay below
the threshold together (the WAND bound); of the others only those blocks are
opened whose maxima reach it; only their postings are added up.  All passages
are treated: windows that overlap by half, as wide as twice the longest item.

Retrieved items are verified: enough of the three-word sequences of the
item's question and of its answer (its last sentence, if it has several)
must stand in the passage.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpulse.llm.common import in_slices, mix, with_outputs, word_hashes
from stockpulse.session import materialize

SLICE_CHARS = 1 << 20
BLOCK_ITEMS = 16
PASS_BYTES = 32 << 20        # of an index that is held on the driver and in every task at once
OPENED = 1 << 20             # block entries or postings that a task holds at once
K1, B = 1.2, 0.75
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def sequences(words: np.ndarray, width: int = 3) -> np.ndarray:
    """Hashes of all runs of ``width`` words (of all words, if they are fewer)."""
    if not len(words):
        return words
    n = max(1, len(words) - width + 1)
    h = np.zeros(n, np.uint64)
    for i in range(min(width, len(words))):
        h += mix(words[i:i + n] * np.uint64(2 * i + 0x632BE59BD9B4E019))
    return mix(h)


PARTS = "struct<words:array<long>,question:array<long>,answer:array<long>>"


def item_parts(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Word hashes of an item, and the distinct sequences of its question and its answer; None without words."""
    sentences = [w for w in (word_hashes([x], True)[0] for x in SENTENCE.split(text)) if len(w)]
    if not sentences:
        return None
    words = np.concatenate(sentences)
    question = np.concatenate(sentences[:-1]) if len(sentences) > 1 else words
    return words, np.unique(sequences(question)), np.unique(sequences(sentences[-1])) if len(sentences) > 1 else words[:0]


def index_items(items: DataFrame, item_key: str, item_text: str) -> tuple[DataFrame, DataFrame, int]:
    """The written index of all items: (``q``, ``key``, ``length``, ``question``, ``answer``), (``q``, ``term``, ``impact``), and the longest length."""
    @F.pandas_udf(PARTS)
    def parts(texts: pd.Series) -> pd.DataFrame:
        found = [item_parts(t) or (np.zeros(0, np.uint64),) * 3 for t in texts]
        return pd.DataFrame({n: [x[i].view(np.int64) for x in found] for i, n in enumerate(("words", "question", "answer"))})

    rows = items.select(F.monotonically_increasing_id().alias("q"), F.col(f"`{item_key}`").alias("key"), F.col(f"`{item_text}`").alias("t")).where("t is not null")
    kept = materialize(rows.select("q", "key", parts("t").alias("p")).select("q", "key", "p.*").where(F.size("words") > 0), "items")
    kept = kept.withColumn("length", F.size("words").cast("double"))
    n, mean, longest = kept.agg(F.count(F.lit(1)), F.avg("length"), F.max("length")).first()
    tf = kept.select("q", "length", F.explode("words").alias("term")).groupBy("q", "term").agg(F.max("length").alias("length"), F.count(F.lit(1)).cast("double").alias("tf"))
    df = tf.groupBy("term").agg(F.count(F.lit(1)).cast("double").alias("df"))
    idf = F.log(1 + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.lit(float(mean or 1.0))))
    weighed = tf.join(df, "term").select("q", "term", weight.alias("w"))
    own = weighed.groupBy("q").agg(F.sum("w").alias("own"))
    postings = materialize(weighed.join(own, "q").select("q", "term", (F.col("w") / F.col("own")).cast("float").alias("impact")), "item-postings")
    return kept.drop("words"), postings, int(longest or 0)


@dataclass
class ItemIndex:
    """One pass's lists: ``term`` t has the block entries from ``entry[t]`` on, an entry its block, maximum and the postings from ``first`` on."""
    ids: list
    terms: np.ndarray      # sorted word hashes
    list_max: np.ndarray   # a term's largest impact
    entry: np.ndarray      # terms + 1
    block: np.ndarray
    block_max: np.ndarray
    first: np.ndarray      # entries + 1
    item: np.ndarray       # of postings, by term and item
    impact: np.ndarray
    question: list[np.ndarray]
    answer: list[np.ndarray]
    stride: int

    @classmethod
    def build(cls, keys: list, lengths: np.ndarray, question: list, answer: list, of: np.ndarray, term: np.ndarray, impact: np.ndarray, longest: int) -> "ItemIndex | None":
        """From items and their (item number, term, impact) rows."""
        if not len(keys):
            return None
        order = np.argsort(lengths, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        item = place[of]
        by = np.lexsort((item, term))
        term, item, impact = term[by], item[by], impact[by]
        starts = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
        first = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (item[1:] // BLOCK_ITEMS != item[:-1] // BLOCK_ITEMS)))
        return cls([keys[i] for i in order], term[starts], np.maximum.reduceat(impact, starts), np.append(np.searchsorted(first, starts), len(first)),
                   item[first] // BLOCK_ITEMS, np.maximum.reduceat(impact, first), np.append(first, len(item)), item, impact,
                   [question[i] for i in order], [answer[i] for i in order], max(64, longest))

    def search(self, texts: list[str], least: float) -> Iterator[tuple[int, int, float, np.ndarray]]:
        """(text, item, score, the passage's words) of every passage and item with a score of ``least`` or more."""
        for lo, hi in in_slices(texts, SLICE_CHARS):
            words, of = word_hashes(texts[lo:hi], True)
            if not len(words):
                continue
            at = np.searchsorted(self.terms, words)
            at[at == len(self.terms)] = 0
            known = np.flatnonzero(self.terms[at] == words)
            if not len(known):
                continue
            first = np.searchsorted(of, np.arange(hi - lo))
            strides = -(-np.bincount(of, minlength=hi - lo) // self.stride)
            base = np.cumsum(strides + 1) - strides  # a text's first stride; the one before it belongs to no other text
            stride = base[of[known]] + (known - first[of[known]]) // self.stride
            # the window that begins at a stride holds that stride and the next
            pairs = np.unique(np.concatenate([stride, stride - 1]) * len(self.terms) + np.tile(at[known], 2))
            window, term = np.divmod(pairs, len(self.terms))
            starts = np.flatnonzero(np.append(True, window[1:] != window[:-1]))
            sizes = np.diff(np.append(starts, len(window)))
            able = np.repeat(np.add.reduceat(self.list_max[term].astype(np.float64), starts) >= least - 1e-4, sizes)
            window, term = window[able], term[able]
            for a, b in self._cuts(window, np.diff(self.entry)[term]):
                for w, i, score in self._scores(window[a:b], term[a:b], least):
                    doc = int(np.searchsorted(base - 1, w, side="right") - 1)
                    begin = first[doc] + max(0, (w - base[doc])) * self.stride
                    end = first[doc] + (w - base[doc] + 2) * self.stride
                    stop = first[doc + 1] if doc + 1 < len(first) else len(words)
                    yield lo + doc, i, score, words[begin:min(end, stop)]

    @staticmethod
    def _cuts(window: np.ndarray, cost: np.ndarray) -> Iterator[tuple[int, int]]:
        """Ranges of whole windows whose block entries are about ``OPENED``."""
        if len(window):
            edges = np.append(np.flatnonzero(np.append(True, window[1:] != window[:-1])), len(window))
            part = (np.append(0, np.cumsum(cost))[edges[:-1]] // OPENED).astype(np.int64)
            cuts = np.append(edges[:-1][np.flatnonzero(np.append(True, part[1:] != part[:-1]))], len(window))
            yield from zip(cuts[:-1].tolist(), cuts[1:].tolist())

    def _scores(self, window: np.ndarray, term: np.ndarray, least: float) -> Iterator[tuple[int, int, float]]:
        """(window, item, score) above the threshold: block maxima first, then the postings of the blocks that reach it."""
        rows, entry = _spread(self.entry, term)
        group, summed = _added(window[rows], self.block[entry], self.block_max[entry])
        good = (summed >= least - 1e-4)[group]
        entry, own = entry[good], window[rows[good]]
        for a, b in self._cuts(own, np.diff(self.first)[entry]):
            yield from self._opened(own[a:b], entry[a:b], least)

    def _opened(self, window: np.ndarray, entry: np.ndarray, least: float) -> Iterator[tuple[int, int, float]]:
        rows, posting = _spread(self.first, entry)
        if not len(rows):
            return
        w, i = window[rows], self.item[posting]
        group, summed = _added(w, i, self.impact[posting])
        one = np.unique(group, return_index=True)[1]
        for g, at in zip(group[one], one):
            if summed[g] >= least - 1e-4:
                yield int(w[at]), int(i[at]), float(summed[g])

    def verify(self, item: int, passage: np.ndarray) -> tuple[float, float, float]:
        """Shares of the question's, the answer's and all sequences that stand in the passage."""
        # a question or answer of one or two words is a sequence of its own width
        have = np.concatenate([sequences(passage, n) for n in (1, 2, 3)])
        q, a = self.question[item], self.answer[item]
        got = [float(np.isin(want, have).mean()) if len(want) else 1.0 for want in (q, a)]
        return got[0], got[1], (got[0] * len(q) + got[1] * len(a)) / max(1, len(q) + len(a))


def _spread(edges: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For lists given by their ``edges``: the place of every chosen list, repeated for each member, and the members."""
    counts = edges[chosen + 1] - edges[chosen]
    rows = np.repeat(np.arange(len(chosen)), counts)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(edges[chosen], counts)


def _added(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each row, by equal (``a``, ``b``), and the groups' sums."""
    group = np.unique(a.astype(np.int64) * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1]
    return group, np.bincount(group, weights=values.astype(np.float64))


def match_benchmark(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
                    least: float = 0.7, min_question: float = 0.7, min_answer: float = 0.5, min_all: float = 0.8,
                    pass_bytes: int = PASS_BYTES) -> DataFrame:
    """Add ``matches``: the items a text leaks, as (item, score, question, answer), by item.

    An item is leaked by a passage whose normalised BM25 score is ``least`` or
    more, if ``min_question`` of the question's sequences stand in it, and
    ``min_answer`` of the answer's or ``min_all`` of both.  The best passage
    of a text counts.  The index is searched in passes of about ``pass_bytes``
    of it (by the item's hash); scores and window widths come from all items,
    so the passes change nothing.  One pass is a column of the texts; of
    several each writes the texts that leak, by their digests, which are then
    joined.

    Null or wordless texts leak nothing, null or wordless items are never
    leaked; an item with a null key is reported with a null item.  Repeated
    items are reported each.  No row is dropped; an input column ``matches``
    is replaced.
    """
    spark = docs.sparkSession
    kind = "long" if dict(items.dtypes)[item_key] in ("tinyint", "smallint", "int", "bigint") else "string"
    kept, postings, longest = index_items(items.withColumn(item_key, F.col(f"`{item_key}`").cast(kind)), item_key, item_text)
    size = kept.agg(F.coalesce(F.sum(100 + 8 * (F.size("question") + F.size("answer"))), F.lit(0))).first()[0] + 20 * postings.count()
    passes = max(1, -(-size // pass_bytes))
    schema = f"array<struct<item:{kind},score:double,question:double,answer:double>>"
    limits = (least, min_question, min_answer, min_all)
    none = F.array().cast(schema)
    t = F.col(f"`{text}`")
    digest = lambda: [F.xxhash64(t).alias("_d1"), F.xxhash64(F.lit(1), t).alias("_d2")]
    found = None
    for n in range(passes):
        index = _collect_pass(kept, postings, longest, passes, n)
        if index is None:
            continue
        shared = spark.sparkContext.broadcast(index)
        if passes == 1:
            return _with_matches(docs, F.array_sort(_match_udf(shared, schema, limits)(t)))
        leaks = docs.where(t.isNotNull()).select(*digest(), _match_udf(shared, schema, limits)(t).alias("m")).where(F.size("m") > 0).dropDuplicates(["_d1", "_d2"])
        leaks = materialize(leaks, "leaks")
        shared.unpersist()
        found = leaks if found is None else found.unionAll(leaks)
    if found is None:
        return _with_matches(docs, none)
    found = found.groupBy("_d1", "_d2").agg(F.array_sort(F.flatten(F.collect_list("m"))).alias("m")).select(F.col("_d1").alias("_e1"), F.col("_d2").alias("_e2"), "m")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *digest())
    met = rows.join(found, (F.col("_d1") == F.col("_e1")) & (F.col("_d2") == F.col("_e2")), "left")
    return met.select(*[F.col(f"row.`{c}`") for c in docs.columns if c.lower() != "matches"], F.coalesce("m", none).alias("matches"))


def _with_matches(docs: DataFrame, matches: Column) -> DataFrame:
    return with_outputs(docs, {"matches": matches})


def _collect_pass(kept: DataFrame, postings: DataFrame, longest: int, passes: int, n: int) -> ItemIndex | None:
    """One pass's part of the index, of about ``PASS_BYTES``."""
    mine = F.pmod(F.xxhash64("q"), F.lit(passes)) == n
    rows = kept.where(mine).orderBy("q").collect()
    lists = postings.where(mine).toPandas()
    qs = np.array([r["q"] for r in rows], np.int64)
    bits = lambda a: np.array(a, np.int64).view(np.uint64)
    return ItemIndex.build([r["key"] for r in rows], np.array([r["length"] for r in rows]), [bits(r["question"]) for r in rows], [bits(r["answer"]) for r in rows],
                           np.searchsorted(qs, lists["q"].to_numpy(np.int64)), lists["term"].to_numpy(np.int64).view(np.uint64), lists["impact"].to_numpy(np.float32), longest)


def _match_udf(shared, schema: str, limits: tuple[float, ...]):
    least, min_question, min_answer, min_all = limits

    @F.pandas_udf(schema)
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = shared.value
        for batch in batches:
            texts = [t if t is not None else "" for t in batch]
            best: list[dict] = [{} for _ in texts]
            for doc, item, score, passage in index.search(texts, least):
                q, a, both = index.verify(item, passage)
                if q >= min_question and (a >= min_answer or both >= min_all):
                    found = (round(min(score, 1.0), 6), q, a)
                    best[doc][item] = max(found, best[doc].get(item, found))
            yield pd.Series([[{"item": index.ids[i], "score": s, "question": q, "answer": a} for i, (s, q, a) in sorted(b.items())] for b in best])

    return match


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", **kwargs) -> DataFrame:
    """The input's rows and columns, without the texts that leak an item.

    Null texts stay, repeated rows all stay or all go, an empty table stays
    empty, and without items every row stays.
    """
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("text"))
    return match_benchmark(marked, items, **kwargs).where(F.size("matches") == 0).select("_row.*")
