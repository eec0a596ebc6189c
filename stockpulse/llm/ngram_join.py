"""N-gram Jaccard self-join of texts with MinHash bands and exact verification.

A text is the set of its five-word shingles (lower case, split at white
space; a shorter text is one shingle).  Texts with equal sets are one node.
Every node has one MinHash band of the same depth in each of ``trees`` tables.
The depth is the longest at which a pair at the threshold meets in some table
with the target recall, by formula and not from the data (no LSH forest is
built); nodes with an equal band are candidates.

A band is represented by its smallest member, the pivot.  Two candidates
share a pivot, so grouping by pivot keeps every candidate pair while each
node's shingles travel once a pivot instead of once a tree.  Large groups are
dealt out as pairs of bounded blocks.  Inside a block pair the exact Jaccard
similarity of all its candidates is computed by matrix products; what leaves
it is each node's number of links and a spanning forest, never the pairs.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpulse.llm.common import in_slices, mix, word_hashes
from stockpulse.llm.graph import connected_components
from stockpulse.session import materialize

SLICE_CHARS = 1 << 19
TREES, FULL_DEPTH = 20, 12
BLOCK = 256


def prefix_depth(threshold: float, recall: float, trees: int = TREES, full_depth: int = FULL_DEPTH) -> int:
    """The longest prefix at which a pair of similarity ``threshold`` meets in one of ``trees`` tries with ``recall``."""
    depth = full_depth
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < recall:
        depth -= 1
    return depth


def shingle_sets(texts: list[str], width: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; empty for a text without words."""
    out: list[np.ndarray] = []
    for a, b in in_slices(texts, SLICE_CHARS):
        words, of = word_hashes(texts[a:b])
        bounds = np.searchsorted(of, np.arange(b - a + 1))
        odd = [np.uint64(2 * i + 0x632BE59BD9B4E019) for i in range(width)]
        for s, e in zip(bounds[:-1], bounds[1:]):
            w = words[s:e]
            n = max(1, len(w) - width + 1) if len(w) else 0
            h = np.zeros(n, np.uint64)
            for i in range(min(width, len(w))):
                h += mix(w[i:i + n] * odd[i])
            out.append(np.unique(mix(h)))
    return out


def _prefixes(sets: list[np.ndarray], depth: int, trees: int) -> np.ndarray:
    """One hash of the signature prefix for every set and tree (sets must not be empty)."""
    rng = np.random.default_rng(20)
    mul = rng.integers(1, 1 << 63, trees * depth, np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 1 << 63, trees * depth, np.uint64)
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), trees), np.uint64)
    for t in range(trees):
        h = np.full(len(sets), t + 1, np.uint64)
        for i in range(t * depth, (t + 1) * depth):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat((flat * mul[i] + add[i]) >> np.uint64(20), starts))
        out[:, t] = h
    return out


def _signature_udf(width: int, depth: int, trees: int):
    @F.pandas_udf("node long, prefixes array<long>")
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t if t is not None else "" for t in batch]
            nodes, prefixes = [None] * len(texts), [None] * len(texts)
            for a, b in in_slices(texts, SLICE_CHARS):
                sets = shingle_sets(texts[a:b], width)
                full = [i for i, s in enumerate(sets) if len(s)]
                if full:
                    found = _prefixes([sets[i] for i in full], depth, trees).view(np.int64)
                    for i, p in zip(full, found):
                        nodes[a + i] = int.from_bytes(hashlib.blake2b(sets[i].tobytes(), digest_size=8).digest(), "little", signed=True)
                        prefixes[a + i] = p
            yield pd.DataFrame({"node": pd.array(nodes, "Int64"), "prefixes": prefixes})

    return sign


def _shingle_udf(width: int):
    @F.pandas_udf("binary")
    def shingles(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([s.tobytes() for s in shingle_sets([t if t is not None else "" for t in batch], width)])

    return shingles


def _intersections(rows: list[np.ndarray], cols: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of two lists of sorted sets, by products of bounded indicator matrices."""
    if len(rows) * len(cols) <= 16:
        return np.array([[len(np.intersect1d(r, c, assume_unique=True)) for c in cols] for r in rows], np.int64)
    values, where = np.unique(np.concatenate([*rows, *cols]), return_inverse=True)
    n_left = sum(map(len, rows))
    left, right = (np.bincount(w, minlength=len(values)) for w in (where[:n_left], where[n_left:]))
    shared = np.cumsum((left > 0) & (right > 0)) - 1  # columns that both sides have
    keep = (left > 0) & (right > 0)
    out = np.zeros((len(rows), len(cols)))
    owner = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (rows, cols)]
    sides = [(o[keep[w]], shared[w[keep[w]]]) for o, w in zip(owner, (where[:n_left], where[n_left:]))]
    for lo in range(0, int(keep.sum()), 4096):
        m = []
        for (o, c), n in zip(sides, out.shape):
            own = (c >= lo) & (c < lo + 4096)
            x = np.zeros((n, 4096), np.float32)
            x[o[own], c[own] - lo] = 1
            m.append(x)
        out += m[0] @ m[1].T
    return out.astype(np.int64)


def _links(nodes: np.ndarray, sets: list[np.ndarray], pivots: list[np.ndarray], side: np.ndarray, pivot: int,
           same_block: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of every node that this block pair counts, and the smallest node each is connected to here."""
    sizes = np.array([len(s) for s in sets])
    a = np.arange(len(sets)) if same_block else np.flatnonzero(side == 0)
    b = a if same_block else np.flatnonzero(side == 1)
    root, links = nodes.copy(), np.zeros(len(sets), np.int64)
    if not len(a) or not len(b):
        return links, root
    both = _intersections([sets[i] for i in a], [sets[i] for i in b])
    union = sizes[a][:, None] + sizes[b][None, :] - both
    linked = (both >= threshold * union - 1e-9) & (nodes[a][:, None] != nodes[b][None, :])
    x, y = np.nonzero(linked)
    if same_block:
        x, y = x[x < y], y[x < y]
    x, y = a[x], b[y]
    for i, j in zip(x.tolist(), y.tolist()):
        # candidates under several pivots are counted under the smallest one they share
        if (len(pivots[i]) == 1 or len(pivots[j]) == 1) or pivot == np.intersect1d(pivots[i], pivots[j], assume_unique=True)[0]:
            links[i] += 1
            links[j] += 1
    while len(x):
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        if (new == root).all():
            break
        root = new
    return links, root


def _verify(threshold: float):
    """Reads rows sorted by (pivot, i, j) and treats one block pair at a time."""
    def flush(key, rows) -> pd.DataFrame | None:
        pivot, i, j = key
        nodes = np.array([r[0] for r in rows], np.int64)
        side = np.array([0 if r[1] == i else 1 for r in rows])
        links, root = _links(nodes, [np.frombuffer(r[2], np.uint64) for r in rows], [np.sort(np.asarray(r[3], np.int64)) for r in rows], side, pivot, i == j, threshold)
        found = (links > 0) | (root != nodes)
        return pd.DataFrame({"node": nodes[found], "root": root[found], "links": links[found]}) if found.any() else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, out = None, [], []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("pivot", "i", "j", "node", "block", "shingles", "pivots")]
            for p, i, j, *row in zip(*cols):
                if (p, i, j) != key:
                    if len(rows) > 1 and (found := flush(key, rows)) is not None:
                        out.append(found)
                    key, rows = (p, i, j), []
                rows.append(row)
            if out:
                yield pa.RecordBatch.from_pandas(pd.concat(out), preserve_index=False)
                out = []
        if len(rows) > 1 and (found := flush(key, rows)) is not None:
            yield pa.RecordBatch.from_pandas(found, preserve_index=False)

    return run


def jaccard_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.8, recall: float = 0.999,
                    width: int = 5, block: int = BLOCK) -> DataFrame:
    """Per row: key, ``text_hash``, ``node``, ``class_id``, ``copy_of`` and ``n_links``.

    ``node`` is a 64-bit digest of the shingle set, ``copy_of`` the smallest
    key with that set, ``class_id`` the smallest key of the connected group,
    ``n_links`` the number of other sets of similarity ``threshold`` or more.
    Links are between sets, so copies need not be expanded.  ``recall`` is the
    chance that a pair just at the threshold becomes a candidate; every
    reported link is verified exactly on the whole texts' shingles.

    A text without words (or null) has a null node, no links, and is its own
    class.  Repeated rows share their class.  Null keys are never
    representatives unless their whole group has null keys; the class is then
    null.  An empty table gives an empty result; other columns aren't returned.
    """
    depth = prefix_depth(threshold, recall)
    t = F.col(text)
    rows = docs.select(F.col(key).alias(key), F.xxhash64(t).alias("text_hash"), _signature_udf(width, depth, TREES)(t).alias("s"))
    rows = materialize(rows.select(key, "text_hash", "s.node", "s.prefixes"), "signatures")
    buckets = rows.where("node is not null").select("node", F.explode("prefixes").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("pivot"), F.max("node").alias("other")).where("pivot != other").select("bucket", "pivot")
    under = buckets.join(shared, "bucket").select("pivot", "node").distinct()
    under = materialize(under, "candidates")

    pivots = under.groupBy("node").agg(F.collect_set("pivot").alias("pivots"))  # at most one a tree
    first = rows.groupBy("node").agg(F.min(F.struct(F.col(key).isNull().alias("no_key"), F.col(key).alias("k"), F.col("text_hash").alias("h"))).alias("first"))
    wanted = pivots.join(first, "node").select("node", "pivots", F.col("first.k").alias("k"), F.col("first.h").alias("h"))
    wanted = materialize(wanted, "candidate-texts")
    texts = (docs.select(F.col(key).alias("k2"), t.alias("text")).withColumn("h2", F.xxhash64("text"))
             .join(wanted.hint("shuffle_hash"), F.col("k").eqNullSafe(F.col("k2")) & (F.col("h") == F.col("h2"))))
    sets = texts.select("node", "pivots", _shingle_udf(width)("text").alias("shingles"))

    groups = under.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    placed = (under.join(groups, "pivot").join(sets, "node")
              .withColumn("block", F.pmod(F.xxhash64(F.lit(3), "node"), F.col("blocks")).cast("int"))
              .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("pivot", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "node", "block", "shingles", "pivots"))
    verified = (placed.repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j", "node")
                .mapInArrow(_verify(threshold), "node long, root long, links long"))
    verified = materialize(verified, "links")

    found = connected_components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = verified.groupBy("node").agg(F.sum("links").alias("n_links"))
    grouped = first.where("node is not null").select("node", F.col("first.k").alias("copy_of")).join(found, "node", "left").join(links, "node", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "node"))
    least = grouped.groupBy("component").agg(F.min("copy_of").alias("class_id"))
    known = grouped.join(least, "component").select("node", "copy_of", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    out = rows.select(key, "text_hash", "node").join(known, "node", "left")
    alone = F.col("node").isNull()
    return out.select(key, "text_hash", "node", F.when(alone, F.col(key)).otherwise(F.col("class_id")).alias("class_id"),
                      F.when(alone, F.col(key)).otherwise(F.col("copy_of")).alias("copy_of"),
                      F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_one_per_class(docs: DataFrame, key: str = "doc_id", text: str = "text", **kwargs) -> DataFrame:
    """The input's rows and columns, with one row of every class (that of the smallest key and text hash).

    Texts without words all stay, repeated rows among them too.
    """
    classes = jaccard_classes(docs, key, text, **kwargs)
    grouped = classes.where("node is not null")
    # one row a class: count, to see whether the row itself is repeated
    same = grouped.groupBy("class_id", key, "text_hash").agg(F.count(F.lit(1)).alias("_n"), F.min("node").alias("_node"))
    pick = same.groupBy(F.coalesce(F.col("class_id").cast("string"), F.concat(F.lit("null "), F.col("_node").cast("string")))).agg(
        F.min(F.struct(F.col(key).isNull().alias("no_key"), F.col(key).alias("k"), F.col("text_hash").alias("h"), F.col("_n").alias("n"))).alias("p"))
    pick = pick.select(F.col("p.k").alias("_k"), F.col("p.h").alias("_h"), F.col("p.n").alias("_n"))
    has_words = F.coalesce(F.col(text), F.lit("")).rlike(r"[^\s\p{Z}\x1C-\x1F\x85]")
    hashed = docs.withColumn("_text_hash", F.xxhash64(F.col(text)))
    kept = hashed.where(has_words).join(pick.hint("shuffle_hash"), F.col(key).eqNullSafe(F.col("_k")) & (F.col("_text_hash") == F.col("_h")))
    once = kept.where("_n = 1").select(docs.columns)
    repeated = kept.where("_n > 1").dropDuplicates([key, "_text_hash"]).select(docs.columns)
    return once.unionAll(repeated).unionAll(docs.where(~has_words))
