"""Mixing sources to target weights by hierarchical budgeting.

Rows are leaves of a domain - language - source tree.  A token budget goes
down the tree by the children's weights.  A child whose whole subtree cannot
take its share (supply times the epochs allowed) is filled, and what it
leaves goes to its siblings by their weights; only when all siblings are full
does the shortage stay with the ancestor's siblings, since a node's capacity
is the sum of its children's.

A leaf's budget is spent in seeded epochs: each epoch is an order of the
leaf's rows by a hash of seed, epoch and key.  Whole epochs take every row;
the last one takes the prefix whose tokens fit.  The prefix is found without
ordering a leaf in one place: rows fall into hash buckets of bounded size,
bucket sums give the bucket in which the budget ends, and only that bucket is
ordered.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpulse.llm.common import uniform
from stockpulse.session import materialize

MAX_LEAVES = 100_000


def words_as_tokens(text: str) -> Column:
    """Stretches without white space, as a count of tokens (null: none)."""
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))).cast("long")


def share_out(budget: int, weights: list[float], capacity: list[int]) -> list[int]:
    """Whole parts of a budget by weight, none above its capacity; what full parts leave goes to the others.

    Parts of weight 0 get something only when all others are full, then
    evenly.  The parts add up to the budget, or to all capacities.
    """
    budget = min(budget, sum(capacity))
    out, live = [0] * len(weights), [i for i, c in enumerate(capacity) if c > 0]
    left = budget
    while live and left:
        w = [weights[i] for i in live]
        if sum(w) <= 0:
            w = [1.0] * len(live)
        total = sum(w)
        full = [i for i, x in zip(live, w) if out[i] + left * x / total >= capacity[i]]
        if full:
            for i in full:
                left -= capacity[i] - out[i]
                out[i] = capacity[i]
            live = [i for i in live if out[i] < capacity[i]]
            # what the others got so far stays: shares are counted anew from what is left
            continue
        shares = [left * x / total for x in w]
        for i, s in zip(live, shares):
            out[i] += int(s)
        rest = left - sum(int(s) for s in shares)
        for i in sorted(live, key=lambda i: (-(shares[live.index(i)] % 1), i))[:rest]:
            out[i] += 1
        left = 0
    return out


def leaf_budgets(supply: dict[tuple, int], budget: int, weights: dict[tuple, float], max_epochs: int) -> dict[tuple, int]:
    """Tokens for every leaf (a path of names).

    ``weights`` maps a path of any length (a domain, a domain and language,
    ...) to its weight among its siblings; a path that isn't listed weighs 1.
    """
    children, capacity = defaultdict(set), defaultdict(int)
    for leaf, tokens in supply.items():
        for depth in range(len(leaf) + 1):
            capacity[leaf[:depth]] += tokens * max_epochs
            if depth:
                children[leaf[:depth - 1]].add(leaf[:depth])
    out: dict[tuple, int] = {}

    def spread(node: tuple, tokens: int) -> None:
        below = sorted(children[node], key=lambda p: tuple((x is not None, x or "") for x in p))
        if not below:
            out[node] = tokens
            return
        parts = share_out(tokens, [weights.get(p, 1.0) for p in below], [capacity[p] for p in below])
        for p, n in zip(below, parts):
            spread(p, n)

    if supply:
        spread((), min(budget, capacity[()]))
    return out


def mix_to_budget(docs: DataFrame, budget: int | None = None, weights: dict[tuple, float] | None = None, domain: Column | None = None,
                  lang: str = "lang", source: str = "source", text: str = "text", key: str = "doc_id", tokens: Column | None = None,
                  max_epochs: int = 2, seed: int = 13, rows_per_bucket: int = 20_000) -> DataFrame:
    """Add ``n_tokens``, ``leaf_budget`` and ``copies`` (the epochs that take the row) to every row.

    ``budget`` defaults to the input's tokens.  A leaf's copies never hold
    more than its budget: the last epoch stops before the first row that does
    not fit.  Null domains, languages and sources are names of their own.
    Rows without tokens (null or empty texts) are free and taken as far as the
    epoch reaches.  Rows repeated with one key and text stand at one place in
    the order and are taken together; null keys are ordered by their text.  An
    empty table gives an empty result.  The leaf table (at most ``MAX_LEAVES``
    rows, an error beyond) is budgeted on the driver.  Input columns named
    like an output are replaced.
    """
    spark = docs.sparkSession
    path = [(domain if domain is not None else F.lit("all")).cast("string"), F.col(lang).cast("string"), F.col(source).cast("string")]
    identity = [F.col(key), F.xxhash64(F.col(text))]
    n = tokens if tokens is not None else words_as_tokens(text)
    rows = docs.select(*[p.alias(f"p{i}") for i, p in enumerate(path)], n.alias("n"), identity[0].alias("key"), identity[1].alias("hash"))
    rows = materialize(rows, "mix-rows")
    leaves = rows.groupBy("p0", "p1", "p2").agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("rows")).limit(MAX_LEAVES + 1).collect()
    if len(leaves) > MAX_LEAVES:
        raise ValueError(f"more than {MAX_LEAVES} leaves; weigh coarser sources")
    supply = {(r["p0"], r["p1"], r["p2"]): r["tokens"] for r in leaves}
    budgets = leaf_budgets(supply, sum(supply.values()) if budget is None else budget, weights or {}, max_epochs)
    plan = []
    for i, r in enumerate(leaves):
        leaf = (r["p0"], r["p1"], r["p2"])
        epochs, rest = divmod(budgets[leaf], supply[leaf]) if supply[leaf] else (max_epochs, 0)
        plan.append((*leaf, i, budgets[leaf], int(epochs), int(rest), -(-r["rows"] // rows_per_bucket)))
    plan = spark.createDataFrame(plan, "l0 string, l1 string, l2 string, leaf int, leaf_budget long, epochs int, rest long, buckets int")

    def placed(df: DataFrame, names: list[Column], key_: list[Column], plan_: DataFrame) -> DataFrame:
        """Join the leaf's plan (a checked number of short rows) and find the row's place ``u`` and bucket in the last epoch."""
        on = [F.col(f"l{i}").eqNullSafe(c) for i, c in enumerate(names)]
        place = df.join(F.broadcast(plan_), on[0] & on[1] & on[2], "left").drop("l0", "l1", "l2")
        return (place.withColumn("u", uniform(F.lit(seed), "epochs", *key_))
                .withColumn("b", F.floor(F.col("u") * F.col("buckets")).cast("int")))

    ordered = placed(rows, [F.col("p0"), F.col("p1"), F.col("p2")], [F.col("key"), F.col("hash")], plan)
    sums = ordered.groupBy("leaf", "b").agg(F.sum("n").alias("tokens"), F.max("rest").alias("rest"))  # leaves x buckets
    upto = F.sum("tokens").over(Window.partitionBy("leaf").orderBy("b"))
    ends = (sums.select("leaf", "b", "rest", "tokens", upto.alias("upto")).where("upto > rest")
            .groupBy("leaf").agg(F.min(F.struct("b", (F.col("upto") - F.col("tokens")).alias("before"))).alias("e"))
            .select(F.col("leaf").alias("end_leaf"), F.col("e.b").alias("end_b"), F.col("e.before").alias("before")))
    ends = materialize(ends, "mix-ends")
    # one bucket a leaf is ordered; equal places count together
    so_far = Window.partitionBy("leaf").orderBy("u").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = (ordered.join(F.broadcast(ends), (F.col("leaf") == F.col("end_leaf")) & (F.col("b") == F.col("end_b")))
            .select("leaf", "u", "rest", (F.col("before") + F.sum("n").over(so_far)).alias("upto"))
            .where("upto <= rest").groupBy(F.col("leaf").alias("cut_leaf")).agg(F.max("u").alias("cut")))
    plan = materialize(plan.join(ends, F.col("leaf") == F.col("end_leaf"), "left").join(cuts, F.col("leaf") == F.col("cut_leaf"), "left")
                       .select("l0", "l1", "l2", "epochs", "buckets", "leaf_budget", "end_b", "cut"), "mix-plan")

    inner = {"_mix_n": n, "_mix_key": identity[0], "_mix_hash": identity[1], **{f"_mix_p{i}": c for i, c in enumerate(path)}}
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_mix_row"), *[c.alias(k) for k, c in inner.items()])
    out = placed(own, [F.col(f"_mix_p{i}") for i in range(3)], [F.col("_mix_key"), F.col("_mix_hash")], plan)
    before_end = F.col("end_b").isNull() | (F.col("b") < F.col("end_b"))
    last = before_end | ((F.col("b") == F.col("end_b")) & F.coalesce(F.col("u") <= F.col("cut"), F.lit(False)))
    # a leaf that spends whole epochs has nothing left for another
    more = last & (F.col("epochs") < max_epochs)
    added = {"n_tokens": F.col("_mix_n"), "leaf_budget": F.col("leaf_budget"), "copies": F.col("epochs") + more.cast("int")}
    taken = {c.lower() for c in added}
    return out.select(*[F.col(f"_mix_row.`{c}`").alias(c) for c in docs.columns if c.lower() not in taken], *[c.alias(k) for k, c in added.items()])


def expand_copies(mixed: DataFrame) -> DataFrame:
    """Each row as often as its ``copies`` say, without the three added columns."""
    kept = [c for c in mixed.columns if c not in ("n_tokens", "leaf_budget", "copies")]
    return mixed.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*[F.col(f"`{c}`") for c in kept])
