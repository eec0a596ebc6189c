"""Ranked search against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from stockpulse.llm import lexical_search as ls

SPLIT = re.compile(ls.TERM)


def words(text):
    return SPLIT.findall((text or "").translate(str.maketrans(ls.UPPER, ls.LOWER)))


def plain(docs, items, k):
    """Rows (item, rank, doc, score) by scoring all documents for all items."""
    tf = [(key, Counter(words(t))) for key, t in docs]
    tf = [(key, c) for key, c in tf if c]
    n_all, l_all = len(tf), sum(sum(c.values()) for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    out = []
    for item, text in items:
        terms = {t for t in words(text) if t in df}
        scored = []
        for key, c in tf:
            m = 100 - 90 + (90 * sum(c.values()) * n_all) // l_all
            s = sum(math.floor(1000 * math.log((2.0 * n_all + 2) / (2.0 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if s > 0:
                scored.append((-s, key is None, key or 0, key))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scored)[:k])]
    return out


def got(frame):
    return sorted(map(tuple, frame.select("item_id", "rank", "doc", "score").collect()), key=repr)


def corpus(n=700, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Ünï", "日本語", "x9"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 5, 20, 80])))) for i in range(n)]


@pytest.mark.parametrize("shard_bytes,k,batch", [(1 << 24, 10, 1000), (9_000, 3, 4), (1, 10, 1000)])
def test_ranks_equal_plain_scores(spark, monkeypatch, shard_bytes, k, batch):
    monkeypatch.setattr(ls, "WINDOW", 64)
    docs = corpus(120 if shard_bytes == 1 else 700)
    items = [(i, t) for i, (_, t) in enumerate(corpus(30, 9))]
    index = ls.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), shard_bytes=shard_bytes)
    found = ls.rank_documents(index, spark.createDataFrame(items, "item_id long, text string"), k=k, items_a_batch=batch)
    assert got(found) == sorted(plain(docs, items, k), key=repr)


def test_block_maxima_reject_before_decompression():
    docs = corpus(6_000)
    kind = ls.pa.schema([("shard", ls.pa.int64()), ("term", ls.pa.string()), ("df", ls.pa.int64()),
                         ("blocks", ls.pa.list_(ls.pa.struct([("last", ls.pa.int64()), ("impacts", ls.pa.list_(ls.pa.struct([("tf", ls.pa.int64()), ("n", ls.pa.int64())]))), ("data", ls.pa.binary())]))),
                         ("docs", ls.pa.list_(ls.pa.struct([("id", ls.pa.int64()), ("n", ls.pa.int64())])))])
    rows = ls.shard_rows(0, ls.pa.array([k for k, _ in docs]), [t for _, t in docs], kind).to_pylist()
    held = rows[0]["docs"]
    lengths = np.array([d["n"] for d in held])
    norms = 10 + 90 * lengths * len(docs) // lengths.sum()
    lists = {r["term"]: ls.Postings(math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * r["df"] + 1))), r["df"], r["blocks"], lengths, norms) for r in rows[1:]}
    assert sum(len(x.data) for x in lists.values()) > len(lists)   # some lists have several blocks
    for r in rows[1:]:   # block maxima are exact, and the postings come back
        x, whole = lists[r["term"]], []
        for b, most in enumerate(x.most):
            doc, gain = x.blocks(b, b + 1)
            assert gain.max() == most and doc[-1] == x.last[b]
            whole += doc.tolist()
        assert len(whole) == r["df"] and whole == x.span(0, len(docs))[0].tolist()
    stats, fresh = {}, [ls.Postings(x.weight, r["df"], r["blocks"], lengths, norms) for r in rows[1:] for x in [lists[r["term"]]] if r["term"] in {"w0", "w1", "w2", "w40", "w90", "w250"}]
    ids, scores = ls.best_documents(fresh, len(docs), np.arange(len(docs)), 10, stats)
    assert stats["rejected"] > 0 and not all(x.opened.all() for x in fresh)
    want = np.zeros(len(docs), np.int64)
    for x in fresh:
        doc, gain = x.span(0, len(docs))
        want[doc] += gain
    assert ids.tolist() == np.lexsort((np.arange(len(docs)), -want))[:10].tolist() and scores.tolist() == want[ids].tolist()


def test_packed_numbers_come_back():
    values = np.array([0, 1, 127, 128, 16_383, 16_384, 2**31, 2**50], np.int64)
    data, width = ls.pack(values)
    assert ls.unpack(data).tolist() == values.tolist() and width.sum() == len(data)


def test_edges(spark):
    long = "lang " * 400_000 + "Nadel"
    rows = [(1, None, 0), (2, "", 0), (3, "...", 0), (None, "apfel birne", 0), (4, "Apfel apfel", 0), (4, "Apfel apfel", 0), (5, "apfel apfel", 1),
            (6, long, 0), (7, "naïve 日本語", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score long")
    items = spark.createDataFrame([(1, "APFEL"), (1, "APFEL"), (None, "nadel"), (2, None), (3, "??"), (4, "Naïve"), (5, "fehlt")], "item_id long, text string")
    index = ls.build_index(docs)
    found = got(ls.rank_documents(index, items))
    assert found == sorted(plain([r[:2] for r in rows], [(1, "APFEL"), (1, "APFEL"), (None, "nadel"), (4, "Naïve")], 10), key=repr)
    assert [r[1:3] for r in found if r[0] is None] == [(1, 6)]
    none = spark.createDataFrame([], "doc_id long, text string")
    assert ls.rank_documents(ls.build_index(none), items).collect() == []
    assert ls.rank_documents(index, items.limit(0)).collect() == []
    named = spark.createDataFrame([("b", "x"), ("a", "x"), ("c", "y z")], "doc_id string, text string")
    assert [(r["doc"], r["rank"]) for r in ls.rank_documents(ls.build_index(named), spark.createDataFrame([(1, "x")], "item_id int, text string")).orderBy("rank").collect()] == [("a", 1), ("b", 2)]
