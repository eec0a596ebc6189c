"""Secret scans: fixed patterns, and randomness tests with false-discovery control.

Spans of three fixed patterns (assignments, access keys, hexadecimal runs)
always count.  Further candidates are unbroken strings of key characters with
a letter.  The narrowest alphabet that holds a candidate is its inferred
encoding, and a battery runs on its symbols:

* the likelihood ratio of a random string of the encoding to an ordinary one.
  Ordinary strings have the letters of the corpus's words (counted in all
  texts, candidates left out) and change between digits, small and capital
  letters at ``changes`` of their places.  An ordinary string reaches a ratio
  of x with a chance of 1 / x at most (Markov), which is the p-value that
  discoveries are controlled on; shares of digits don't count;
* chi-squared uniformity over the alphabet, a runs test about the alphabet's
  middle, and a serial correlation of neighbours.  Random symbols pass them
  at ``alpha``; counters, repeated blocks and words do not.

False discoveries are controlled by Benjamini-Hochberg inside bands of
length over all candidates of the corpus, from a histogram of binned p-values
(bands x bins rows at most).  Everything is a column expression.

Measured on made texts, one candidate of ten random, about 25 keys a group:
upper-case hex of 20 / 24 / 32 / 40 characters 64 / 67 / 89 / 90 % found,
lower-case letters and digits of the same lengths all; none of 1,800 ordinary
strings (words joined with numbers) was taken.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpulse.llm.common import with_outputs
from stockpulse.session import materialize

# The patterns of the contract.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # what is left of all [0-9a-f]+ after dropping those below 24
KINDS = ["assign", "access", "hex", "random"]

CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
# Alphabets from narrow to wide: name, pattern, and the symbols in order of value.
DIGITS, UPPER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = [
    ("hex_lower", "^[0-9a-f]+$", DIGITS + "abcdef"),
    ("hex_upper", "^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base32", "^[A-Z2-7]+$", UPPER + "234567"),
    ("base36_lower", "^[0-9a-z]+$", DIGITS + UPPER.lower()),
    ("base36_upper", "^[0-9A-Z]+$", DIGITS + UPPER),
    ("base64", "^[A-Za-z0-9+/]+$", UPPER + UPPER.lower() + DIGITS + "+/"),
    ("base64_url", "^[A-Za-z0-9_-]+$", UPPER + UPPER.lower() + DIGITS + "-_"),
    ("mixed", "^[A-Za-z0-9+/_-]+$", UPPER + UPPER.lower() + DIGITS + "+/-_"),
]
BANDS = [20, 24, 32, 48, 64, 128]  # lower bounds of length
BINS_PER_DECADE, MAX_DECADES = 10, 30
CHANGE = "(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])"
#: Letters of English in 16,000, added to the corpus's counts (so that a few short texts alone don't make the model).
PRIOR = dict(zip(UPPER.lower(), [16 * n for n in [82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1]]))


def _spans(text: Column, pattern: str, kind: str, least: int, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as structs (start, order, kind, end), in code points.

    The stretches between the matches come from splitting at the pattern, so
    running sums of the lengths of stretches and matches give the places.
    Matches whose ``group`` is shorter than ``least`` are dropped.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.char_length).alias("gap"),
        F.transform(found, F.char_length).alias("len"),
        (F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found).alias("what"))
    order = F.lit(KINDS.index(kind))
    empty = F.array().cast("array<struct<start:int,ord:int,kind:string,end:int>>")
    state = F.aggregate(
        F.filter(parts, lambda p: p["len"].isNotNull()),
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda s, p: F.struct(
            (s["at"] + p["gap"] + p["len"]).alias("at"),
            F.when(F.char_length(p["what"]) >= least, F.concat(s["out"], F.array(F.struct(
                (s["at"] + p["gap"]).alias("start"), order.alias("ord"), F.lit(kind).alias("kind"),
                (s["at"] + p["gap"] + p["len"]).alias("end"))))).otherwise(s["out"]).alias("out")))
    return F.when(text.rlike(pattern), state["out"]).otherwise(empty)


def letter_counts(docs: DataFrame, text: str = "text") -> dict[str, int]:
    """How often the letters a to z stand in the words of all texts, plus ``PRIOR``."""
    t = F.lower(F.regexp_replace(F.col(text), CANDIDATE, " "))
    counts = docs.select(t.alias("t")).agg(
        *[F.coalesce(F.sum(F.char_length("t") - F.char_length(F.replace("t", F.lit(c), F.lit("")))), F.lit(0)).alias(c) for c in PRIOR]).first()
    return {c: n + counts[c] for c, n in PRIOR.items()}


def _evidence(token: Column, name: Column, letters: dict[str, int], changes: float) -> Column:
    """log10 of the likelihood ratio of a random string of the encoding to an ordinary one; signs don't count."""
    core = F.regexp_replace(token, "[+/_-]", "")

    def gains(alphabet: str) -> Column:
        total = sum(letters[c] for c in alphabet)
        return F.create_map(*[F.lit(x) for c in alphabet for x in (c, math.log10(total / len(alphabet) / letters[c]))])

    def rate(symbols: str) -> float:
        """The chance that neighbours in a random string change."""
        kinds = [sum(c in kind for c in symbols) for kind in (DIGITS, UPPER.lower(), UPPER)]
        d, low, up = (n / sum(kinds) for n in kinds)
        return 2 * d * (low + up) + low * up

    known = F.when(name.isin("hex_lower", "hex_upper"), gains("abcdef")).otherwise(gains(UPPER.lower()))
    by_letter = F.aggregate(F.split(F.lower(core), ""), F.lit(0.0), lambda s, c: s + F.coalesce(F.try_element_at(known, c), F.lit(0.0)))
    changed = F.regexp_count(core, F.lit(CHANGE))
    stayed = F.greatest(F.char_length(core) - 1, F.lit(0)) - changed
    gain = lambda kept: F.coalesce(*[F.when(name == n, F.lit(math.log10((1 - rate(s)) / (1 - changes) if kept else rate(s) / changes))) for n, _, s in ENCODINGS])
    return by_letter + changed * gain(False) + stayed * gain(True)


def _battery(token: Column, letters: dict[str, int], changes: float) -> Column:
    """The test statistics of one candidate as a struct; a null encoding (never, by the pattern) gives null."""
    symbols = F.coalesce(*[F.when(token.rlike(p), F.lit(s)) for _, p, s in ENCODINGS])
    name = F.coalesce(*[F.when(token.rlike(p), F.lit(n)) for n, p, _ in ENCODINGS])
    n, k = F.char_length(token).cast("double"), F.char_length(symbols).cast("double")
    squares = F.aggregate(F.array_distinct(F.split(token, "")), F.lit(0.0),
                          lambda s, c: s + F.when(c == "", 0.0).otherwise(F.pow(n - F.char_length(F.replace(token, c, F.lit(""))), F.lit(2))))
    chi2 = k * squares / n - n
    z_even = (chi2 - (k - 1)) / F.sqrt(2 * (k - 1))
    values = F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.instr(symbols, c).cast("double"))
    high = F.transform(values, lambda v: (v > (k + 1) / 2).cast("int"))
    ones = F.aggregate(high, F.lit(0), lambda s, v: s + v).cast("double")
    zeros = n - ones
    runs = 1 + F.aggregate(F.zip_with(F.slice(high, 1, F.size(high) - 1), F.slice(high, 2, F.size(high) - 1), lambda a, b: (a != b).cast("int")),
                           F.lit(0), lambda s, v: s + v)
    mean = 2 * ones * zeros / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    z_runs = F.when(var > 0, (runs - mean) / F.sqrt(var)).otherwise(F.lit(99.0))
    centre, scale = (k + 1) / 2, (k * k - 1) / 12
    lagged = F.aggregate(F.zip_with(F.slice(values, 1, F.size(values) - 1), F.slice(values, 2, F.size(values) - 1),
                                    lambda a, b: (a - centre) * (b - centre)), F.lit(0.0), lambda s, v: s + v)
    z_serial = lagged / (scale * F.sqrt(n - 1))
    return F.struct(name.alias("encoding"), _evidence(token, name, letters, changes).alias("evidence"), z_even.alias("z_even"), z_runs.alias("z_runs"), z_serial.alias("z_serial"))


def _band(length: Column) -> Column:
    return F.aggregate(F.array(*[F.lit(b) for b in BANDS]), F.lit(-1), lambda s, b: s + (length >= b).cast("int"))


def scan_documents(docs: DataFrame, text: str = "text", changes: float = 0.15) -> DataFrame:
    """All columns but the text, with ``_base`` spans and ``_candidates`` with their statistics (no text is kept).

    ``changes``: the share of places at which an ordinary string changes between digits, small and capital letters.
    """
    letters = letter_counts(docs, text)
    t = F.coalesce(F.col(text), F.lit(""))
    base = F.array_sort(F.concat(_spans(t, ASSIGN, "assign", 6, 2), _spans(t, ACCESS, "access", 20), _spans(t, HEX, "hex", 24)))
    # a candidate's own text is needed for its statistics alone
    found = F.regexp_extract_all(t, F.lit(CANDIDATE), F.lit(0))
    places = _spans(t, CANDIDATE, "random", 20)
    pairs = F.filter(F.arrays_zip(places.alias("span"), found.alias("token")),
                     lambda p: p["token"].rlike("[A-Za-z]"))
    candidates = F.when(t.rlike(CANDIDATE), F.transform(pairs, lambda p: F.struct(
        p["span"]["start"].alias("start"), p["span"]["end"].alias("end"), _band(F.char_length(p["token"])).alias("band"),
        _battery(p["token"], letters, changes).alias("test"))))
    rest = [c for c in docs.columns if c.lower() != text.lower()]
    return docs.select(*[F.col(f"`{c}`") for c in rest], base.alias("_base"), candidates.alias("_candidates"))


def scan_secrets(docs: DataFrame, text: str = "text", fdr: float = 0.01, alpha_z: float = 3.29, even_z: float = 5.0, changes: float = 0.15) -> DataFrame:
    """Per row ``n_assign``, ``n_access``, ``n_hex``, ``n_random``, ``base_sha256``, ``spans`` and ``findings``.

    ``spans`` joins all spans as kind:start:end by start, then kind; offsets
    are code points, the end exclusive.  A random span that meets a base span
    is not listed again.  ``fdr`` is the share of false discoveries allowed
    in each band of length; the runs and serial statistics of a random string
    stay within ``alpha_z`` standard deviations, its chi-squared statistic
    (which has a longer tail) at most ``even_z`` above the mean.

    A null text counts as empty: no spans, and the digest of the empty string.
    Rows are neither dropped nor joined, so repeated rows and null keys keep
    their own results; an empty table gives an empty result.  The text column
    is not returned; input columns named like an output are replaced.
    """
    scanned = materialize(scan_documents(docs, text, changes), "secret-candidates")
    tests = scanned.select(F.explode("_candidates").alias("c")).select(
        F.col("c.band").alias("band"),
        F.least(F.lit(BINS_PER_DECADE * MAX_DECADES), F.floor(F.greatest(F.lit(0.0), F.col("c.test.evidence")) * BINS_PER_DECADE)).cast("int").alias("bin"))
    histogram = tests.groupBy("band", "bin").agg(F.count(F.lit(1)).alias("n"))  # bands x bins rows
    ranks = histogram.select(
        "band", "bin", F.sum("n").over(Window.partitionBy("band").orderBy(F.desc("bin"))).alias("at_least"),
        F.sum("n").over(Window.partitionBy("band")).alias("m"))
    # p <= 10 ** (-bin / bins a decade) for all tests in the bin: the largest p that still satisfies the step-up rule
    passed = ranks.where(F.pow(F.lit(10.0), -F.col("bin") / BINS_PER_DECADE) <= fdr * F.col("at_least") / F.col("m"))
    limits = passed.groupBy("band").agg(F.min("bin").alias("bin")).agg(
        F.map_from_entries(F.collect_list(F.struct("band", "bin"))).alias("limits")).select("limits").scalar()
    marked = scanned.withColumn("_limits", limits)
    bin_ = lambda c: F.floor(F.greatest(F.lit(0.0), c["test"]["evidence"]) * BINS_PER_DECADE)
    random = F.filter(F.coalesce(F.col("_candidates"), F.array().cast(scanned.schema["_candidates"].dataType)), lambda c: (
        (bin_(c) >= F.col("_limits")[c["band"]])
        & (c["test"]["z_even"] <= even_z) & (F.abs(c["test"]["z_runs"]) <= alpha_z) & (F.abs(c["test"]["z_serial"]) <= alpha_z)
        & ~F.exists(F.col("_base"), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))))
    marked = marked.withColumn("_random", random)
    added = F.transform("_random", lambda c: F.struct(c["start"].alias("start"), F.lit(KINDS.index("random")).alias("ord"), F.lit("random").alias("kind"), c["end"].alias("end")))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long")
    every = F.array_sort(F.concat(F.col("_base"), added))
    return with_outputs(marked, {
        **{f"n_{kind}": count(kind) for kind in KINDS[:3]},
        "n_random": F.size("_random").cast("long"),
        "base_sha256": F.sha2(joined(F.col("_base")).cast("binary"), 256),
        "spans": joined(every),
        "findings": F.col("_random"),
    }).drop("_base", "_candidates", "_limits", "_random")
