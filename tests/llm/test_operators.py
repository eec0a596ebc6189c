"""Every operator against brute force, an independent formulation, or held-out accuracy."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockpulse.llm import decontaminate, language, lines, mixing, ngram_join, quality, queries, secret_scan, sharding, tokens, toxicity
from stockpulse.llm.graph import connected_components

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


# ---- 1

def test_language_of_held_out_documents(spark, docs):
    got = {r["doc_id"]: r for r in queries.QUERIES["op1_language_mixture"](spark, SF).collect()}
    held = [(r["lang"], got[r["doc_id"]]) for r in docs.collect() if got[r["doc_id"]]["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2) for k, r in got.items())
    assert sum(lang == r["lang_pred"] for lang, r in held) >= 0.98 * len(held)


def test_mixture_proportions(docs):
    model = language.fit_language_model(docs)
    pure = {}
    for r in docs.where("n_chars > 1500").select("lang", "text").collect():
        pure.setdefault(r["lang"], " ".join(r["text"].split()[:200]))
    pi, words = language.infer(model, [pure["en"], pure["de"], pure["en"] + "\n" + pure["de"]], penalty=12.0)
    assert (pi[0] > 0).sum() == 1 and words[2] == words[0] + words[1]
    at = [model.langs.index(x) for x in ("en", "de")]
    assert (pi[2] > 0).sum() == 2 and all(abs(pi[2][i] - n / words[2]) < 0.1 for i, n in zip(at, words))


def test_documents_in_several_languages_stay_and_noise_goes(spark, docs):
    model = language.fit_language_model(docs)
    pure = {}
    for r in docs.where("n_chars > 1500").select("lang", "text").collect():
        pure.setdefault(r["lang"], []).append(r["text"].split())
    rng = random.Random(8)
    mixed = [" ".join(rng.choice(pure["en"])[:90] + rng.choice(pure["de"])[:70] + rng.choice(pure["fr"])[:40]) for _ in range(20)]
    noise = ["".join(rng.choice("бгджзйклмнпрстфхцчшщ") for _ in range(6)) + " qzx" for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(mixed + [" ".join(noise * 5), "ok", "x", "Ünïq"])] + [(90, None), (91, "123 !")]
    kept = {r["doc_id"] for r in language.keep_identified(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert kept == {*range(20), 21, 22, 23}
    whole = {r["doc_id"] for r in language.keep_identified(docs, model).collect()}
    assert whole == {r["doc_id"] for r in docs.collect() if re.search(r"[^\W\d_]", r["text"] or "")}


def test_every_language_value_is_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "TABLE_CELLS", 1 << 16)
    rng = random.Random(1)
    letters = {f"l{i:03d}": "".join(rng.sample("abcdefghijklmnopqrstuvwxyz", 4)) for i in range(60)}
    rows = [(i, name, " ".join("".join(rng.choices(own, k=5)) for _ in range(80))) for i, (name, own) in enumerate(letters.items())]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = language.fit_language_model(df)
    assert len(model.langs) == 60 and model.log_p.size <= 1 << 16 and model.bits < 16
    got = language.identify_languages(df, model).collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 55


def test_em_against_plain_em_over_all_sets(docs):
    """The chosen mixture costs no more than that of any set of languages, found by plain loops."""
    import itertools
    model = language.fit_language_model(docs)
    text = " ".join(" ".join(r["text"].split()[:25]) for r in docs.where("n_chars > 1500").limit(3).collect())
    pi, words = language.infer(model, [text], 12.0)
    h, first, _ = language.letter_trigrams([text], model.bits)
    ll = np.stack([np.add.reduceat(p[h], first) for p in model.log_p], axis=1).astype(np.float64)

    def cost(allowed):
        q = np.exp(ll[:, allowed] - ll.max(axis=1, keepdims=True))
        p = np.full(len(allowed), 1 / len(allowed))
        for _ in range(500):
            r = q * p
            p = (r / r.sum(axis=1, keepdims=True)).mean(axis=0)
        return -2 * (ll.max(axis=1) + np.log((q * p).sum(axis=1))).sum() + 12.0 * len(allowed) * math.log(len(ll) + 1)

    every = {s: cost(list(s)) for k in range(1, len(model.langs) + 1) for s in itertools.combinations(range(len(model.langs)), k)}
    got = tuple(int(i) for i in np.flatnonzero(pi[0] > 0))
    assert every[got] <= min(every.values()) + 1e-3 * abs(min(every.values())) and words[0] == len(ll)


# ---- 2

def _waterfill(budget, weights, capacity):
    lo, hi = 0.0, 1e12
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(c, mid * w) for w, c in zip(weights, capacity)) < budget else (lo, mid)
    return [min(c, hi * w) for w, c in zip(weights, capacity)]


def test_share_out_is_water_filling():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(1, 6)
        weights, capacity = [rng.randint(1, 9) for _ in range(n)], [rng.randint(0, 1000) for _ in range(n)]
        budget = rng.randint(0, 3000)
        got = mixing.share_out(budget, weights, capacity)
        assert sum(got) == min(budget, sum(capacity)) and all(0 <= g <= c for g, c in zip(got, capacity))
        if budget < sum(capacity):
            assert all(abs(g - e) <= n for g, e in zip(got, _waterfill(budget, weights, capacity)))


def test_shortage_goes_to_siblings_before_ancestors():
    supply = {("a", "x", "1"): 10, ("a", "x", "2"): 1000, ("a", "y", "1"): 1000, ("b", "x", "1"): 1000}
    got = mixing.leaf_budgets(supply, 800, {}, 1)
    assert got == {("a", "x", "1"): 10, ("a", "x", "2"): 190, ("a", "y", "1"): 200, ("b", "x", "1"): 400}


@pytest.mark.parametrize("per_bucket", [20_000, 7])
def test_epochs_take_a_prefix_of_the_seeded_order(docs, per_bucket):
    weights = {("all", "en"): 1.0, ("all", "fr"): 9.0}
    got = mixing.mix_to_budget(docs, budget=250_000, weights=weights, max_epochs=3, rows_per_bucket=per_bucket)
    got = got.withColumn("epochs", F.lit(0))
    rows = got.collect()
    assert len(rows) == docs.count()
    leaves = defaultdict(list)
    for r in rows:
        leaves[r["lang"], r["source"]].append(r)
    supply = {("all", *k): sum(r["n_tokens"] for r in v) for k, v in leaves.items()}
    budgets = mixing.leaf_budgets(supply, 250_000, weights, 3)
    place = {(r["doc_id"], e): r["u"] for e in range(4) for r in docs.select(
        "doc_id", mixing.uniform(F.lit(13), F.lit(e), "doc_id", F.xxhash64("text")).alias("u")).collect()}
    for leaf, v in leaves.items():
        whole, rest = divmod(budgets["all", *leaf], supply["all", *leaf])
        taken = 0
        for r in sorted(v, key=lambda r: place[r["doc_id"], whole]):
            taken += r["n_tokens"]
            assert r["leaf_budget"] == budgets["all", *leaf]
            assert r["copies"] == whole + (taken <= rest and whole < 3), (leaf, r["doc_id"])


# ---- 3

def test_measures(docs, texts):
    got = quality.text_measures(docs.select("doc_id", "text")).collect()
    for r in got:
        t = texts[r["doc_id"]]
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        c = Counter(zip(w, w[1:], w[2:]))
        again = {k + j for k in range(len(w) - 2) if c[tuple(w[k:k + 3])] > 1 for j in range(3)}
        ls = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert [r[x] for x in quality.COUNTS] == [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(ls) - len(set(ls)), len(again)]


def test_a_planted_conjunction_is_learned(spark):
    rng = random.Random(3)
    rows = [(i, rng.randint(50, 500), rng.randint(0, 50), rng.randint(0, 9)) for i in range(3000)]
    df = spark.createDataFrame([(i, w, 5 * w, s, d, 0, 5.0, s / w, 0.0, d / w, 0 if s > 30 and d > 5 else 1) for i, w, s, d in rows],
                               f"doc_id long, {', '.join(f'{m} long' for m in quality.COUNTS)}, {', '.join(f'{m} double' for m in quality.RATES)}, quality int")
    found = quality.learn_decision_list(df)
    wrong = df.where(found.verdict().cast("int") != F.col("quality")).count()
    assert wrong <= 30 and len(found.rules) <= 4
    assert df.where((found.rule_number() > 0) == found.verdict()).count() == 0


# ---- 4

def _sets(texts):
    out = {}
    for k, t in texts.items():
        w = t.lower().split()
        out[k] = frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    return out


@pytest.mark.parametrize("block", [256, 4])
def test_jaccard_classes_against_all_pairs(spark, block):
    rng = random.Random(4)
    base = [[f"w{rng.randint(0, 3000)}" for _ in range(120)] for _ in range(12)]
    texts = {}
    for i in range(150):
        w = list(base[0] if i < 60 else base[i % 12])  # one large group of near copies
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"x{rng.randint(0, 99)}"
        texts[i] = " ".join(w)
    texts.update({200: texts[3], 201: texts[3], 202: "one two", 203: "One  two"})
    sets = _sets(texts)
    distinct = list(dict.fromkeys(sets.values()))
    links, parent = Counter(), list(range(len(distinct)))
    find = lambda x: x if parent[x] == x else find(parent[x])
    for i, a in enumerate(distinct):
        for j in range(i):
            if 10 * len(a & distinct[j]) >= 8 * len(a | distinct[j]):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    number = {s: i for i, s in enumerate(distinct)}
    low = {}
    for k, s in sorted(sets.items(), reverse=True):
        low[find(number[s])] = k
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in ngram_join.jaccard_classes(df, block=block).collect()}
    assert sum(links.values()) > 300
    assert {k: (r["class_id"], r["n_links"]) for k, r in got.items()} == {k: (low[find(number[s])], links[number[s]]) for k, s in sets.items()}


def test_prefix_depth_reaches_the_recall():
    d = ngram_join.prefix_depth(0.8, 0.999)
    assert 1 - (1 - 0.8 ** d) ** ngram_join.TREES >= 0.999 > 1 - (1 - 0.8 ** (d + 1)) ** ngram_join.TREES


# ---- 5

ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def _base(t):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24])


def test_base_spans(spark, texts):
    rng = random.Random(5)
    made = ["".join(rng.choice(["password", "API_key", "apikey", "TOKEN ", "=", ": ", '"', "AKIA", "ABCD1234", "deadbeef01", "🙂é", " ", "x.y", "\n"])
                    for _ in range(rng.randint(0, 40))) for _ in range(800)]
    every = {**texts, **{10_000 + i: t for i, t in enumerate(made)}}
    df = spark.createDataFrame(list(every.items()), "doc_id long, text string")
    for r in secret_scan.scan_secrets(df).collect():
        want = _base(every[r["doc_id"]])
        joined = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in want) for i in range(3)]
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [s for s in r["spans"].split(",") if s and not s.startswith("random")] == (joined.split(",") if joined else [])


def test_keys_of_small_alphabets_are_found_among_ordinary_strings(spark):
    rng = random.Random(7)
    words = "order item user profile image service project release number customer invoice table the with from that this have which their".split()
    sets = {"hex": "0123456789ABCDEF", "lower": "0123456789abcdefghijklmnopqrstuvwxyz"}
    rows, kind = [], {}
    for i in range(2000):
        text = " ".join(rng.choice(words) for _ in range(30))
        if i % 10 == 0:
            kind[i] = (rng.choice(list(sets)), rng.choice([20, 24, 32, 40]))
            key = "".join(rng.choice(sets[kind[i][0]]) for _ in range(kind[i][1]))
        else:
            key = ""
            while len(key) < 20:
                key += rng.choice(words) + rng.choice(["", "-", "_"]) + rng.choice(["", str(rng.randint(0, 9)), str(rng.randint(2000, 2030)), f"{rng.randint(0, 99999):08d}"])
            key += str(rng.randint(0, 9))
        rows.append((i, f"{text} {key} {text}"))
    got = {r["doc_id"]: r["n_random"] for r in secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = Counter(kind[i] for i in kind if got[i])
    share = {k: found[k] / n for k, n in Counter(kind.values()).items()}
    print(sorted(share.items()), sum(got[i] for i in got if i not in kind))
    assert all(share[k] >= 0.7 for k in share if k[1] >= 32) and sum(found.values()) >= 0.75 * len(kind)
    assert sum(got[i] for i in got if i not in kind) <= 0.03 * len(kind)


def test_letters_are_counted_in_every_text(spark):
    rows = [(i, f"{'qz' * (i % 7)} QX text {i}") for i in range(200)] + [(200, None), (201, ""), (202, "zz" * 20)]   # the last is a candidate
    got = secret_scan.letter_counts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    words = Counter("".join(t for _, t in rows[:200]).lower())
    assert got == {c: n + words[c] for c, n in secret_scan.PRIOR.items()}


def test_random_strings_are_found_and_ordinary_ones_are_not(spark):
    rng = random.Random(6)
    letters = secret_scan.UPPER + secret_scan.UPPER.lower() + secret_scan.DIGITS
    rows = [(i, "key " + "".join(rng.choice(letters) for _ in range(40)) + " end") for i in range(300)]
    plain = ["version1" * 5, "aaaaaaaaaaaaaaaaaaaaaaaaa1", "abcabcabcabcabcabcabcabc1", "the_quick_brown_fox_2_jumps_over", "chapter-1-section-2-paragraph-3"]
    rows += [(1000 + i, f"see {plain[i % len(plain)]} here") for i in range(300)]
    got = {r["doc_id"]: r["n_random"] for r in secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[i] for i in range(300)) >= 280 and sum(got[1000 + i] for i in range(300)) <= 3


# ---- 6

def test_token_counts_equal_the_library(texts):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    path = P.path("byte_bpe_50k.json")
    rng = random.Random(7)
    alphabet = "abestdmrvl'  \n\t.,!?123éß中あ \u0085​　²½🙂\x1c\x1d<|>"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    made += ["<|endoftext|>a<|endoftext|><|endoftext|> b", "a" * 5000, " " * 3000, "\n" * 2000 + "x", " " * 1500 + "'s", "'tis ''s 'r 'rx x'l x'll we'll"]
    made += ["".join(chr(rng.randrange(1, 0x3000)) for _ in range(200)) for _ in range(300)]
    every = list(texts.values()) + made
    counter = tokens.TokenCounter(open(path, encoding="utf-8").read())
    counter.pieces.MAX_STATES = 3000  # compiled states are dropped on the way
    got = counter.counts(every)
    assert got.tolist() == [len(x) for x in Tokenizer.from_file(path).encode_batch(every, add_special_tokens=False)]


def test_chunk_maps_compose(monkeypatch):
    monkeypatch.setattr(tokens, "CHUNK_CHARS", 3)
    s = tokens.Splitter()
    small = s.boundaries(["don't we'll  go\n\n now ''re", "x"])
    monkeypatch.setattr(tokens, "CHUNK_CHARS", 512)
    large = s.boundaries(["don't we'll  go\n\n now ''re", "x"])
    assert small[1].tolist() == large[1].tolist() and small[2].tolist() == large[2].tolist()


# ---- 7

@pytest.mark.parametrize("per_range", [20_000, 20])
def test_shards_are_even_and_gapless(spark, docs, per_range):
    hot = docs.unionByName(docs.where("doc_id = 6").withColumn("doc_id", F.explode(F.sequence(F.lit(5000), F.lit(5600)))))
    rows = sharding.shard_by_bytes(hot, n_shards=8, rows_per_range=per_range).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in hot.select("doc_id").collect())
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    assert sorted(by) == list(range(8))
    for v in by.values():
        assert sorted(r["slot"] for r in v) == list(range(len(v)))
    size = [sum(r["size"] for r in v) for v in by.values()]
    assert max(size) <= 1.12 * sum(size) / 8
    placed = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert all(b["start"] == a["start"] + a["size"] for a, b in zip(placed, placed[1:]))


def _placed_plainly(rows, n_shards, tolerance=0.05):
    """(shard, slot) of every row of an order, by plain sums over it; a row is (text, size)."""
    total = sum(s for _, s in rows)
    groups, start = defaultdict(lambda: [None, 0]), 0
    for t, s in rows:
        groups[t][0] = start if groups[t][0] is None else groups[t][0]
        groups[t][1] += s
        start += s
    out, slots, start = [], Counter(), 0
    for t, s in rows:
        g0, g = groups[t]
        middle = g0 + g / 2 if g <= 2 * tolerance * total / n_shards else start + s / 2
        shard = min(n_shards - 1, int(middle * n_shards / total))
        out.append((shard, slots[shard]))
        slots[shard] += 1
        start += s
    return out


@pytest.mark.parametrize("max_ranges,per_range,broadcast", [(4096, 20_000, 50_000), (8, 200, 50_000), (2, 30, 0), (64, 5, 50_000)])
def test_places_against_plain_sums(spark, monkeypatch, max_ranges, per_range, broadcast):
    """400 texts of 20 copies, a hot text, a hot text with one key, null keys and texts: whatever the ranges, copies stand side by side."""
    monkeypatch.setattr(sharding, "BROADCAST_ROWS", broadcast)
    rng = random.Random(3)
    texts = [f"text {i} " + "x" * rng.randint(0, 60) for i in range(400)]
    rows = [(i, texts[i % 400]) for i in range(8_000)] + [(10_000 + i, "hot") for i in range(2_500)] + [(9_000, "one key")] * 1_500 + [(None, "no key")] * 300 + [(20_000 + i, None) for i in range(200)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sharding.shard_by_bytes(df, n_shards=16, rows_per_range=per_range, max_ranges=max_ranges).collect()
    text_of = {k: t for k, t in rows if k is not None}
    text_of[None] = "no key"
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((k, len((t or "").encode()) + 1) for k, t in rows)
    order = sorted(got, key=lambda r: r["start"])
    assert all(b["start"] == a["start"] + a["size"] for a, b in zip(order, order[1:])) and order[0]["start"] == 0
    runs = 1 + sum(text_of[a["doc_id"]] != text_of[b["doc_id"]] for a, b in zip(order, order[1:]))
    assert runs == 404
    assert [(r["shard"], r["slot"]) for r in order] == _placed_plainly([(text_of[r["doc_id"]], r["size"]) for r in order], 16)
    whole = {t: {r["shard"] for r in got if text_of[r["doc_id"]] == t} for t in texts}
    assert all(len(s) == 1 for s in whole.values())


# ---- 8

def test_toxicity_of_held_out_documents(spark):
    rows = queries.QUERIES["op8_string_kernel_toxicity"](spark, "/root/testdata/sf0.1").collect()
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    held = [(truth[r["doc_id"]], r["score"], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(t == p for t, _, p in held) >= 0.96 * len(held)
    assert sum(p for t, _, p in held if t) >= 0.85 * sum(t for t, _, _ in held)


def test_kernel_tolerates_gaps_and_inserted_letters():
    k = toxicity.Kernel(["worthless", "disgusting"])
    assert k.values(["worthless"])[0, 0] == pytest.approx(1)
    for w in ("worthxless", "wor.th*less", "worthles", "w o r t h l e s s"):
        got = k.sentences([f"you are {w} today"])[0]
        assert len(got) == 1 and got[0, 0] > 0.25, w
    assert len(k.sentences(["a perfectly ordinary sentence"])[0]) == 0


def test_kernel_is_the_sum_over_subsequences():
    def plain(a, b):
        def phi(w):
            w, out = f"^{w}$", Counter()
            for i in range(len(w)):
                for j in range(i + 1, len(w)):
                    for k in range(j + 1, min(len(w), i + toxicity.MAX_SPAN)):
                        out[w[i] + w[j] + w[k]] += toxicity.DECAY ** (k - i + 1)
            return out
        x, y = phi(a), phi(b)
        dot = lambda p, q: sum(v * q[f] for f, v in p.items())
        return dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5
    k = toxicity.Kernel(["moron"])
    for w in ("moron", "morron", "morons", "lalala", "maroon"):
        want = plain(w, "moron")
        assert k.values([w])[0, 0] == pytest.approx(want ** toxicity.POWER if want >= toxicity.FLOOR else 0, abs=1e-5)


# ---- 9

def _simhash(norm):
    xxhash = pytest.importorskip("xxhash")
    hs = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in norm.split(" ")]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def _edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("block", [256, 2])
def test_fuzzy_lines_against_all_pairs(spark, block):
    rng = random.Random(9)
    base = [[f"w{rng.randint(0, 500)}" for _ in range(40)] for _ in range(6)]
    texts = {}
    for i in range(60):
        ls = []
        for _ in range(3):
            w = list(base[0] if rng.random() < 0.5 else rng.choice(base))
            if rng.random() < 0.8:
                w[rng.randrange(40)] = f"y{rng.randint(0, 30)}"
            ls.append(" ".join(w))
        texts[i] = "\n".join(ls + ["Short line!", "", "---"])
    norm = lambda s: re.sub(r"[\W_]+", " ", s.lower()).strip()
    nodes = list(dict.fromkeys(norm(x) for t in texts.values() for x in t.split("\n") if norm(x)))
    parent = list(range(len(nodes)))
    find = lambda x: x if parent[x] == x else find(parent[x])
    for i in range(len(nodes)):
        for j in range(i):
            if _edit(nodes[i], nodes[j]) <= 0.2 * max(len(nodes[i]), len(nodes[j])):
                parent[find(i)] = find(j)
    number, seen, want = {n: i for i, n in enumerate(nodes)}, set(), {}
    for k, t in sorted(texts.items()):
        gone = []
        for i, x in enumerate(t.split("\n")):
            if norm(x):
                g = find(number[norm(x)])
                gone += [i] if g in seen else []
                seen.add(g)
        want[k] = gone
    assert len({find(i) for i in range(len(nodes))}) < 0.8 * len(nodes)
    got = lines.dedup_lines(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), block=block).collect()
    assert {r["doc_id"]: r["dropped_lines"] for r in got} == want
    for r in got:
        assert r["text"] == "\n".join(x for i, x in enumerate(texts[r["doc_id"]].split("\n")) if i not in want[r["doc_id"]])


def _edited(rng, line):
    """A line with a word replaced, dropped or added, or with typing errors, at an edit similarity of 0.8 or more."""
    while True:
        w = list(line)
        kind, at = rng.randrange(4), rng.randrange(len(w))
        if kind == 0:
            w[at] = _word(rng)
        elif kind == 1:
            del w[at]
        elif kind == 2:
            w.insert(at, _word(rng))
        s = list(" ".join(w))
        if kind == 3:
            for _ in range(max(1, len(s) // 20)):
                s[rng.randrange(len(s))] = rng.choice("abcdefghij")
        a, b = " ".join(line), " ".join("".join(s).split())
        if a != b and _edit(a, b) <= 0.2 * max(len(a), len(b)):
            return b


def _word(rng):
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9)))


def _recall(spark, lengths, seed):
    """The share of edited lines that go, by ``lengths`` of words; lines that aren't alike stay."""
    rng = random.Random(seed)
    rows, own = [], []
    for i, n in enumerate(lengths):
        line = [_word(rng) for _ in range(n)]
        edited = _edited(rng, line)
        own.append(True)
        rows += [(2 * i, " ".join(line)), (2 * i + 1, edited)]
    got = {r["doc_id"]: r["n_kept"] for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[2 * i] == 1 for i in range(len(lengths)))
    return sum(1 - got[2 * i + 1] for i, o in enumerate(own) if o) / sum(own)


def test_edited_lines_are_found(spark):
    assert _recall(spark, [10, 12, 15, 20, 30, 45, 60, 90] * 12, 21) >= 0.98


def test_edited_lines_of_two_to_eight_words_are_found(spark):
    assert _recall(spark, [2, 3, 4, 5, 6, 7, 8] * 15, 22) >= 0.9


def _typed(rng, s, n, letters="abcdefghij"):
    s = list(s)
    for i in rng.sample([i for i, c in enumerate(s) if c != " "], n):
        s[i] = rng.choice(letters)
    return "".join(s)


def test_lines_of_any_length_and_script_are_found(spark):
    """Nearly equal lines: 5,000 characters with a letter changed in a quarter of the words; few long words; Han text with and without blanks; one word."""
    rng = random.Random(12)
    han = "".join(chr(0x4E00 + i) for i in range(3_000))

    def very_long():
        words = [_word(rng) for _ in range(850)]
        changed = [_typed(rng, w, 1) if i % 4 == 0 else w for i, w in enumerate(words)]
        return " ".join(words), " ".join(changed)

    def long_words():
        s = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=29)) for _ in range(6))
        return s, _typed(rng, s, 4)

    def han_text(n=200, edits=8, parts=5):
        s = "".join(rng.choices(han, k=n))
        s = " ".join(s[i:i + n // parts] for i in range(0, n, n // parts))
        return s, _typed(rng, s, edits, han)

    def one_word():
        s = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9))
        return s, _typed(rng, s, 1)

    kinds = [(very_long, 10), (long_words, 30), (han_text, 30), (lambda: han_text(60, 1, 1), 30), (one_word, 30)]
    rows, kind = [], {}
    for k, (make, n) in enumerate(kinds):
        for _ in range(n):
            for line in make():
                kind[len(rows)] = k
                rows.append((len(rows), line))
    got = {r["doc_id"]: r["n_kept"] for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == 1 for i in got if i % 2 == 0)
    for k, (_, n) in enumerate(kinds):
        assert sum(got[i] == 0 for i in got if kind[i] == k and i % 2) >= 0.9 * n, k


def test_normalised_lines_and_their_digests():
    texts = ["Hello,  World!\n--\n\nÜnï 日本語 x2 ", "", "\n", "hello world"]
    codes, begins, of = lines.normalised(texts)
    whole = "".join(map(chr, codes))
    got = [(int(t), whole[begins[i]:begins[i + 1]]) for i, t in enumerate(of)]
    assert got == [(0, "hello world"), (0, ""), (0, ""), (0, "ünï 日本語 x2"), (1, ""), (2, ""), (2, ""), (3, "hello world")]
    digests = lines.line_digests(codes, begins)
    assert (digests[0] == digests[7]).all() and (digests[0] != digests[3]).all()


def test_edits_within_a_bound():
    rng = random.Random(4)
    for _ in range(3_000):
        a = "".join(rng.choices("abcé日", k=rng.randint(0, 14)))
        b = "".join(rng.choices("abcé日", k=rng.randint(0, 14))) if rng.random() < 0.5 else _typed(rng, a, min(2, len(a)), "ab日") + rng.choice(["", "c"])
        least = _edit(a, b)
        assert all(lines.within(a, b, k) == (k >= least) for k in range(16)), (a, b)


@pytest.mark.parametrize("pairs_a_word", [0, 4, 1_000_000])
def test_edits_of_many_pairs_at_once(monkeypatch, pairs_a_word):
    monkeypatch.setattr(lines, "PAIRS_A_WORD", pairs_a_word)
    rng = random.Random(5)
    firsts, seconds, allowed, want = [], [], [], []
    for _ in range(150):
        a = "".join(rng.choices("abcé日 ", k=rng.choice([0, 1, 9, 63, 64, 65, 130])))
        b = _typed(rng, a, min(rng.randint(0, 30), len(a) // 2), "ab日") if rng.random() < 0.7 else "".join(rng.choices("abcé日 ", k=max(0, len(a) + rng.randint(-9, 9))))
        least = _edit(a, b)
        firsts.append(a), seconds.append(b), allowed.append(max(0, least + rng.randint(-3, 3)))
        want.append(least <= allowed[-1])
    assert lines.all_within(firsts, seconds, allowed).tolist() == want and 0 < sum(want) < 150
    assert lines.all_within(seconds, firsts, allowed).tolist() == want
    calls = []
    monkeypatch.setattr(lines, "within", lambda *x: calls.append(x) or False)
    lines.all_within(firsts, seconds, allowed)
    assert (len(calls) == 0) == (pairs_a_word == 0)


def test_no_pairs_at_once():
    assert lines.all_within([], [], []).tolist() == []


def test_pairs_with_many_characters_are_compared_one_by_one(monkeypatch):
    monkeypatch.setattr(lines, "MASK_WORDS", 1)
    a = ["".join(chr(0x4E00 + (i * j) % 997) for j in range(70)) for i in range(1, 40)]
    assert lines.all_within(a, [x[:60] + "zz" + x[62:] for x in a], [2] * 39).all()


def test_components(spark):
    rng = random.Random(11)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1060)]
    parent = {x: x for e in edges for x in e}
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len({r["node"] for r in got})
    assert {r["node"]: r["component"] for r in got} == {x: find(x) for a, b in edges if a != b for x in (a, b)}


# ---- 10

def _impacts(items):
    """Normalised BM25 impacts {item: {term: impact}} and the longest item, by plain loops over all items."""
    bags = {i: Counter(decontaminate.item_parts(t)[0].tolist()) for i, t in items.items() if decontaminate.item_parts(t)}
    df, mean = Counter(w for b in bags.values() for w in b), sum(sum(b.values()) for b in bags.values()) / len(bags)
    out = {}
    for i, b in bags.items():
        length = sum(b.values())
        w = {t: math.log(1 + (len(bags) - df[t] + 0.5) / (df[t] + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * length / mean)) for t, n in b.items()}
        out[i] = {t: x / sum(w.values()) for t, x in w.items()}
    return out, max(sum(b.values()) for b in bags.values())


@pytest.mark.parametrize("opened", [1 << 20, 50])
def test_search_against_full_scoring(texts, spark, monkeypatch, opened):
    monkeypatch.setattr(decontaminate, "OPENED", opened)
    frame = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {r["item_id"]: r["text"] for r in frame.collect()}
    index = decontaminate._collect_pass(*decontaminate.index_items(frame, "item_id", "text"), 1, 0)
    impacts, longest = _impacts(items)
    assert index.stride == max(64, longest)
    for t, (a, b) in enumerate(zip(index.entry, index.entry[1:])):   # block maxima are those of their postings
        for e in range(a, b):
            own = slice(index.first[e], index.first[e + 1])
            assert index.block_max[e] == index.impact[own].max() and set(index.item[own] // decontaminate.BLOCK_ITEMS) == {index.block[e]}
    some = [texts[k] for k in sorted(texts)[:200]]
    got = {}
    for d, i, s, _ in index.search(some, 0.25):
        got[d, index.ids[i]] = max(s, got.get((d, index.ids[i]), 0))
    want = {}
    for d, t in enumerate(some):
        w = decontaminate.word_hashes([t], True)[0].tolist()
        for a in range(0, len(w) + index.stride, index.stride):
            have = set(w[max(0, a - index.stride):a + index.stride])
            for i, own in impacts.items():
                score = sum(x for term, x in own.items() if term in have)
                if score >= 0.25:
                    want[d, i] = max(score, want.get((d, i), 0))
    border = {k for k, s in {**got, **want}.items() if abs(s - 0.25) < 1e-3}
    assert got.keys() - border == want.keys() - border and len(got) > 20
    assert all(abs(got[k] - want[k]) < 1e-4 for k in got.keys() & want.keys())


def test_planted_items_are_found(spark, texts):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    norm = lambda s: " ".join(re.findall(r"\w+", s.lower()))
    want = {(k, i) for k, t in texts.items() for i, x in items.items() if f" {norm(x)} " in f" {norm(t)} "}
    got = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op10_benchmark_wand"](spark, SF).collect()}
    assert want and want <= got and len(got - want) <= 0.1 * len(want)


def test_passes_find_the_same(spark, docs):
    """Pairs and scores do not depend on the passes, shortened items and clashing columns included."""
    items = spark.read.parquet(f"{SF}/benchmark.parquet").withColumn("text", F.when(F.col("item_id") % 2 == 0, F.substring("text", 1, 120)).otherwise(F.col("text")))
    some = docs.select("doc_id", "text", F.lit("x").alias("m"), F.lit(1).alias("_d1"))
    found = [sorted((r["doc_id"], m["item"], m["score"], m["question"]) for r in decontaminate.match_benchmark(some, items, pass_bytes=n).collect() for m in r["matches"])
             for n in (32 << 20, 8_000, 2_500)]
    assert found[0] == found[1] == found[2] and len(found[0]) > 20