"""Ranked lexical search: every item ranks all documents by the Block-Max MaxScore method.

``build_index`` cuts the documents into shards of bounded text.  Each task
indexes its own shards, so no posting is shuffled: a row of the written index
is a term of a shard, with its postings in compressed blocks.  Documents of a
shard are numbered by length; a block carries its last number and its
*impacts*, the (occurrences, length) pairs that no other pair of the block
beats in both, from which its largest score follows exactly for any corpus
statistics.

``rank_documents`` joins the index with the items' terms.  One task takes a
shard and a batch of items.  An item's lists are ordered by their global
bounds; those whose bounds together can't reach the k-th best score so far are
not essential.  Documents come from the essential lists only, window by
window; on the others the block maximum rejects a document before the block is
decompressed.  The k best of each shard are merged by a window over the item.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockpulse.session import materialize

SHARD_BYTES = 8 << 20    # text of a shard (a longer text is a shard of its own)
BLOCK = 128              # postings of a block
WINDOW = 4_096           # documents that are accumulated at once
ITEMS_A_BATCH = 1_000
# What the terms are made of, and the letters that are lowered.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_BYTES = np.arange(256)
_INSIDE = (_BYTES >= 0x80) | np.isin(_BYTES, np.frombuffer((UPPER + LOWER + "0123456789").encode(), np.uint8))
_LOWERED = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)


# ---- postings

def occurrences(texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct terms, and for every occurrence its term's number and its text's number."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw])
    data = np.frombuffer(b"\n" + b"\n".join(raw) + b"\n", np.uint8)
    inside = _INSIDE[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begins, stops = edges[::2], edges[1::2]
    offsets = np.concatenate([[0], np.cumsum(stops - begins)]).astype(np.int64)
    kept = _LOWERED[data[inside]]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.searchsorted(ends, begins, side="right")


def pack(values: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Numbers as bytes of seven bits each, lowest first; and each number's byte count."""
    width = 1 + sum((values >> (7 * i) > 0).astype(np.int64) for i in range(1, 9))
    at = np.cumsum(width) - width
    out = np.zeros(int(width.sum()), np.uint8)
    for i in range(int(width.max(initial=0))):
        has = width > i
        out[at[has] + i] = (values[has] >> (7 * i) & 127) | np.where(width[has] > i + 1, 128, 0)
    return out.tobytes(), width


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    begins = np.flatnonzero(np.concatenate([[True], raw[:-1] < 128]))
    place = np.arange(len(raw)) - np.repeat(begins, np.diff(np.append(begins, len(raw))))
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), begins)


def shard_rows(shard: int, ids: pa.Array, texts: list[str], kind: pa.Schema) -> pa.RecordBatch:
    """The index of some documents: a row with the documents, then a row a term."""
    terms, term, text = occurrences(texts)
    lengths = np.bincount(text, minlength=len(texts)).astype(np.int64)
    order = np.argsort(lengths, kind="stable")
    number = np.empty_like(order)
    number[order] = np.arange(len(order))
    n = lengths[order]
    key, tf = np.unique(term * len(texts) + number[text], return_counts=True)
    term, doc = np.divmod(key, len(texts))
    first = np.flatnonzero(np.diff(term, prepend=-1))
    df = np.diff(np.append(first, len(term)))
    place = np.arange(len(term)) - np.repeat(first, df)
    begins = np.flatnonzero(place % BLOCK == 0)
    size = np.diff(np.append(begins, len(term)))
    last = doc[begins + size - 1] if len(begins) else doc
    # documents are numbered by length: a pair is unbeaten if it has more occurrences than all before it in the block
    block = np.repeat(np.arange(len(begins)), size)
    ranked = block * (int(tf.max(initial=0)) + 1) + tf
    best = np.maximum.accumulate(ranked) if len(ranked) else ranked
    unbeaten = np.flatnonzero(np.diff(best, prepend=-1) > 0)
    per_block = np.bincount(block[unbeaten], minlength=len(begins))
    gaps = np.diff(doc, prepend=-1)
    gaps[first] = doc[first] + 1
    data, width = pack(np.stack([gaps, tf], 1).ravel())
    cuts = np.append((np.cumsum(width) - width)[::2][begins], len(data)).astype(np.int64)
    offsets = lambda counts: pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    impacts = pa.ListArray.from_arrays(offsets(per_block), pa.StructArray.from_arrays(
        [pa.array(tf[unbeaten].astype(np.int64)), pa.array(n[doc[unbeaten]])], ["tf", "n"]))
    payload = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(cuts), pa.py_buffer(data)]).cast(pa.binary())
    blocks = pa.StructArray.from_arrays([pa.array(last.astype(np.int64)), impacts, payload], ["last", "impacts", "data"])
    held = pa.StructArray.from_arrays([ids.take(pa.array(order)), pa.array(n)], ["id", "n"])
    m = len(first)
    columns = [
        pa.array(np.full(m + 1, shard, np.int64)),
        pa.concat_arrays([pa.nulls(1, pa.large_binary()), terms]).cast(pa.string()),
        pa.array(np.append(0, df).astype(np.int64)),
        pa.ListArray.from_arrays(pa.array(np.concatenate([[0, 0], np.cumsum(-(-df // BLOCK))]).astype(np.int32)), blocks),
        pa.ListArray.from_arrays(pa.array(np.append(0, np.full(m + 1, len(texts))).astype(np.int32)), held),
    ]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, kind)], schema=kind)


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The written index of all documents: (``shard``, ``term``, ``df``, ``blocks``, ``docs``).

    A shard has one row without a term, which lists its documents and their
    lengths, and a row a term.  Null texts have no term; they and null keys
    are documents like any other, repeated rows are documents each, and an
    empty table has an empty index.
    """
    id_type = docs.schema[key].dataType.simpleString()
    schema = (f"shard long, term string, df long, blocks array<struct<last:long,impacts:array<struct<tf:long,n:long>>,data:binary>>, "
              f"docs array<struct<id:{id_type},n:long>>")
    narrow = docs.select(F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held, shard = [], [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            column, begin = batch.column(0), 0
            for i, t in enumerate(batch.column(1)):
                texts.append(t.as_py())
                held += len(texts[-1])
                if held >= shard_bytes:
                    ids.append(column.slice(begin, i + 1 - begin))
                    yield from term_batches(shard, ids, texts)
                    ids, texts, held, begin, shard = [], [], 0, i + 1, shard + 1
            ids.append(column.slice(begin))
        if texts:
            yield from term_batches(shard, ids, texts)

    def term_batches(shard: int, ids: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
        whole = pa.concat_arrays(ids)
        item = pa.struct([("id", whole.type), ("n", pa.int64())])
        kind = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("df", pa.int64()),
                          ("blocks", pa.list_(pa.struct([("last", pa.int64()), ("impacts", pa.list_(pa.struct([("tf", pa.int64()), ("n", pa.int64())]))),
                                                         ("data", pa.binary())]))), ("docs", pa.list_(item))])
        rows = shard_rows(shard, whole, texts, kind)
        for at in range(0, rows.num_rows, 20_000):
            yield rows.slice(at, 20_000)

    return materialize(narrow.mapInArrow(index, schema), "lexical-index")


# ---- search

class Postings:
    """One term's list in a shard; blocks are decompressed when asked for, and kept."""

    def __init__(self, weight: int, df: int, blocks: list[dict], lengths: np.ndarray, norms: np.ndarray):
        self.weight, self.norms, self.data = weight, norms, [b["data"] for b in blocks]
        self.last = np.array([b["last"] for b in blocks], np.int64)
        counts = [len(b["impacts"]) for b in blocks]
        tf = np.array([i["tf"] for b in blocks for i in b["impacts"]], np.int64)
        n = np.array([i["n"] for b in blocks for i in b["impacts"]], np.int64)
        # impacts name lengths; equal lengths have equal norms
        reach = weight * saturation(tf, norms[np.searchsorted(lengths, n)])
        self.most = np.maximum.reduceat(reach, np.cumsum(counts) - counts)
        self.bound = int(self.most.max())
        self.opened = np.zeros(len(blocks), bool)
        self.doc, self.gain = np.zeros(df, np.int64), np.zeros(df, np.int64)

    def blocks(self, b: int, e: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and gains of the blocks from ``b`` up to, not with, ``e``."""
        closed = b + np.flatnonzero(~self.opened[b:e])
        for run in np.split(closed, np.flatnonzero(np.diff(closed) > 1) + 1) if len(closed) else ():
            i, j = int(run[0]), int(run[-1]) + 1
            gap, tf = unpack(b"".join(self.data[i:j])).reshape(-1, 2).T
            at = slice(i * BLOCK, i * BLOCK + len(gap))
            self.doc[at] = (self.last[i - 1] if i else -1) + np.cumsum(gap)
            self.gain[at] = self.weight * saturation(tf, self.norms[self.doc[at]])
            self.opened[i:j] = True
        return self.doc[b * BLOCK:e * BLOCK], self.gain[b * BLOCK:e * BLOCK]

    def span(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """The postings of the documents from number ``lo`` up to, not with, ``hi``; opens the blocks that may hold them."""
        b, e = np.searchsorted(self.last, (lo, hi))
        doc, gain = self.blocks(int(b), min(int(e) + 1, len(self.last)))
        i, j = np.searchsorted(doc, (lo, hi))
        return doc[i:j], gain[i:j]


def saturation(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1_000 * tf + 8 * m)


def best_documents(lists: list[Postings], n_docs: int, tie: np.ndarray, k: int, stats: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and scores of the ``k`` best documents of a shard; equal scores by ``tie``.

    ``stats`` (tests) counts the documents that block maxima rejected.
    """
    lists = sorted(lists, key=lambda x: x.bound)
    upto = np.concatenate([[0], np.cumsum([x.bound for x in lists])])   # upto[j]: what the j smallest bounds add up to
    docs, scores, least = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
    for lo in range(0, n_docs, WINDOW):
        essential = int(np.searchsorted(upto, least)) - 1   # lists before it can't reach the least score together
        sums = np.zeros(min(WINDOW, n_docs - lo), np.int64)
        for x in lists[essential:]:
            doc, gain = x.span(lo, lo + len(sums))
            sums[doc - lo] += gain
        found = np.flatnonzero(sums)
        score, found = sums[found], found + lo
        for j in range(essential - 1, -1, -1):
            x = lists[j]
            near = score + upto[j + 1] >= least
            found, score = found[near], score[near]
            if not len(found):
                break
            b = np.searchsorted(x.last, found)
            most = np.append(x.most, 0)[b]
            hope = score + most + upto[j] >= least
            if stats is not None:
                stats["rejected"] = stats.get("rejected", 0) + int((~hope).sum())
            found, score, b = found[hope], score[hope], b[hope]
            for at in np.unique(b[b < len(x.last)]):
                doc, gain = x.blocks(int(at), int(at) + 1)
                here = np.flatnonzero(b == at)
                place = np.minimum(np.searchsorted(doc, found[here]), len(doc) - 1)
                score[here] += np.where(doc[place] == found[here], gain[place], 0)
        good = score >= least
        docs, scores = np.concatenate([docs, found[good]]), np.concatenate([scores, score[good]])
        top = np.lexsort((tie[docs], -scores))[:k]
        docs, scores = docs[top], scores[top]
        least = int(scores[-1]) if len(scores) == k else 1
    return docs, scores


def _search_shard(n_all: int, l_all: int, k: int, id_type: pa.DataType):
    out = pa.schema([("q", pa.int64()), ("id", id_type), ("score", pa.int64())])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return out.empty_table()
        rows = left.to_pylist()
        held = next(r["docs"] for r in rows if r["docs"] is not None)
        lengths = np.array([d["n"] for d in held], np.int64)
        norms = 100 - 90 + 90 * lengths * n_all // l_all
        order = sorted(range(len(held)), key=lambda i: (held[i]["id"] is None, 0 if held[i]["id"] is None else held[i]["id"]))
        tie = np.empty(len(held), np.int64)
        tie[order] = np.arange(len(held))
        lists = {r["term"]: Postings(r["w"], r["df"], r["blocks"], lengths, norms) for r in rows if r["term"] is not None}
        q, ids, scores = [], [], []
        for item in right.to_pylist():
            docs, points = best_documents([lists[t] for t in item["terms"] if t in lists], len(held), tie, k)
            q += [item["q"]] * len(docs)
            ids += [held[d]["id"] for d in docs]
            scores += points.tolist()
        return pa.Table.from_arrays([pa.array(q, pa.int64()), pa.array(ids, id_type), pa.array(scores, pa.int64())], schema=out)

    return search


def rank_documents(index: DataFrame, items: DataFrame, item_key: str = "item_id", item_text: str = "text", k: int = 10,
                   items_a_batch: int = ITEMS_A_BATCH) -> DataFrame:
    """(``q``, item key, ``rank``, ``doc``, ``score``): the ``k`` best documents of every item; fewer if fewer score above 0.

    ``q`` numbers the item rows, so repeated items and items with a null key
    are ranked each.  Items without a term, and all items if no document has
    one, have no row.  Equal scores go by ascending document key (null last);
    rows that share the key are ranked each.  Other columns of ``items`` are
    not read.  Only the two corpus totals come to the driver.
    """
    # an arrow type for the key: ask the frame itself
    from pyspark.sql.pandas.types import to_arrow_type

    id_kind = index.schema["docs"].dataType.elementType["id"].dataType
    lowered = F.translate(F.col(f"`{item_text}`"), UPPER, LOWER)
    wanted = materialize(items.select(F.monotonically_increasing_id().alias("q"), F.col(f"`{item_key}`").alias("key"),
                                      F.array_distinct(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("terms"))
                         .where(F.size("terms") > 0), "lexical-items")
    shards = index.where("term is null").select("shard", "docs")
    n_all, l_all = shards.select(F.explode("docs.n").alias("n")).agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    result = f"q long, id {id_kind.simpleString()}, score long"
    if not n_all:
        found = index.sparkSession.createDataFrame([], result)
    else:
        batches = max(1, -(-wanted.count() // items_a_batch))
        batch = F.pmod(F.xxhash64("q"), F.lit(batches)).alias("batch")
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(batches - 1).cast("long"))).alias("batch")
        queries = wanted.select(batch, "q", "terms")
        terms = queries.select("batch", F.explode("terms").alias("term")).distinct()
        postings = index.where("term is not null").join(terms.select("term").distinct(), "term", "left_semi").select("shard", "term", "df", "blocks")
        weight = F.floor(1000 * F.log((F.lit(2.0) * n_all + 2) / (2 * F.sum("df").cast("double") + 1))).cast("long")
        weights = postings.groupBy("term").agg(weight.alias("w"))
        left = (postings.join(weights, "term").join(terms, "term").select("shard", "batch", "term", "w", "df", "blocks", F.lit(None).cast(shards.schema["docs"].dataType).alias("docs"))
                .unionByName(shards.select("shard", every, "docs"), allowMissingColumns=True))
        # the stated items against every shard, by batches
        right = shards.select("shard", every).join(queries, "batch").select(F.col("shard").alias("to_shard"), F.col("batch").alias("to_batch"), "q", "terms")
        search = _search_shard(int(n_all), int(l_all), k, to_arrow_type(id_kind))
        found = left.groupBy("shard", "batch").cogroup(right.groupBy("to_shard", "to_batch")).applyInArrow(search, result)
    best = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(wanted.select("q", "key"), "q").select("q", F.col("key").alias(item_key), "rank", F.col("id").alias("doc"), "score")
