"""Token counts by compiled finite-state transducers.

Two deterministic transducers give the count of byte-level BPE tokens:

* the *splitter* reads code-point classes and marks where the pre-tokenizer
  ends a piece (contractions, letters, numbers, other marks, white space).
  Texts are cut into chunks; every chunk's map "entry state -> exit state"
  is computed for all states at once, the maps compose through a parallel
  prefix scan, and the entry states found that way fix every mark;
* the *piece counter* reads the bytes of one piece.  A state holds what can
  still matter for later merges: the longest suffix that begins a token, and
  for the positions inside it the last token of the encoding that ends there
  with the relative count.  Every transition is annotated with the change of
  the emitted-token count; transitions are compiled when first taken.

The piece counter rests on a property of BPE: the encoding of a prefix is the
encoding of a shorter prefix plus one last token, the one whose pair with the
token before it is stable under the merges.
"""

from __future__ import annotations

import json
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpulse.llm.common import category_table, code_points, in_slices, with_outputs

# White space of the pre-tokenizer's pattern, and the alphabet in which the vocabulary writes bytes.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

SLICE_CHARS = 1 << 20
CHUNK_CHARS = 512

# ---------------------------------------------------------------- splitter

LETTER, NUMBER, OTHER, SPACE, BLANK, QUOTE, STMD, RV, LL, EE = range(10)  # classes
(START, IN_LETTERS, IN_NUMBERS, IN_OTHER, QUOTED, QUOTED_RV, QUOTED_L, CONTRACTED,
 SPACE_1, SPACE_N, BLANK_1, BLANK_N) = range(12)  # states
CUT, CUT_BEFORE = 1, 2  # a piece ends before this character; before the previous one


def class_table() -> np.ndarray:
    classes = np.array([OTHER, LETTER, NUMBER], np.uint8)[category_table()]
    classes[WHITE_SPACE] = BLANK
    classes[0x20] = SPACE
    classes[ord("'")] = QUOTE
    for letters, c in (("stmd", STMD), ("rv", RV), ("l", LL), ("e", EE)):
        classes[[ord(x) for x in letters]] = c
    return classes


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, cuts) for every state and class."""
    goes, cuts = np.zeros((12, 10), np.uint8), np.zeros((12, 10), np.uint8)
    begins = [IN_LETTERS, IN_NUMBERS, IN_OTHER, SPACE_1, BLANK_1, QUOTED] + [IN_LETTERS] * 4
    joins = [*begins[:5], IN_OTHER] + [IN_LETTERS] * 4  # after a space that belongs to the piece
    stays = {IN_LETTERS: (LETTER, STMD, RV, LL, EE), IN_NUMBERS: (NUMBER,), IN_OTHER: (OTHER, QUOTE)}
    for c in range(10):
        for s in range(12):
            to, cut = begins[c], CUT
            if s == START:
                cut = 0
            elif c in stays.get(s, ()):
                to, cut = s, 0
            elif s == QUOTED and c in (OTHER, QUOTE):
                to, cut = IN_OTHER, 0
            elif s == QUOTED and c in (STMD, RV, LL):
                to, cut = {STMD: CONTRACTED, RV: QUOTED_RV, LL: QUOTED_L}[c], 0
            elif s == QUOTED_RV and c == EE or s == QUOTED_L and c == LL:
                to, cut = CONTRACTED, 0
            elif s in (QUOTED_RV, QUOTED_L):  # no contraction: the quote alone was the piece
                inside = c in stays[IN_LETTERS]
                to, cut = (IN_LETTERS, CUT_BEFORE) if inside else (begins[c], CUT_BEFORE | CUT)
            elif s >= SPACE_1 and c in (SPACE, BLANK):
                to, cut = (SPACE_N if c == SPACE else BLANK_N), 0
            elif s == SPACE_1:
                to, cut = joins[c], 0
            elif s == SPACE_N:
                to, cut = joins[c], CUT_BEFORE
            elif s == BLANK_N:
                to, cut = begins[c], CUT_BEFORE | CUT
            goes[s, c], cuts[s, c] = to, cut
    return goes, cuts


def compose_scan(maps: np.ndarray, resets: np.ndarray) -> np.ndarray:
    """State before each chunk: an exclusive prefix scan of the chunk maps (chunks x states).

    ``resets`` marks chunks that begin a text; they start in ``START``.  A map
    whose chunk begins a text is constant, so composition never looks past it.
    Doubling takes log2(chunks) rounds, each over all chunks at once.
    """
    scan = maps.copy()
    scan[resets] = scan[resets, START][:, None]
    step = 1
    while step < len(scan):
        scan[step:] = np.take_along_axis(scan[step:], scan[:-step].copy().astype(np.intp), axis=1)
        step *= 2
    before = np.concatenate([[START], scan[:-1, START]]).astype(np.uint8)
    before[resets] = START
    return before


class Splitter:
    def __init__(self):
        self.classes = class_table()
        goes, cuts = splitter()
        self.goes, self.cuts = goes.ravel(), cuts.ravel()

    def boundaries(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
        """The texts as one string, the ends of all pieces in it, and each piece's text number; texts must not be empty."""
        joined = "".join(texts)
        classes = self.classes[code_points(joined)]
        lengths = np.array([len(t) for t in texts])
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        per = -(-lengths // CHUNK_CHARS)  # chunks a text
        of = np.repeat(np.arange(len(texts)), per)
        number = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        at = first[of] + number * CHUNK_CHARS
        size = np.minimum(CHUNK_CHARS, first[of] + lengths[of] - at)
        order = np.argsort(-size, kind="stable")  # longest first: chunks that have ended form a tail
        at, size = at[order], size[order]
        live = [int(np.searchsorted(-size, -k, side="left")) for k in range(int(size[0]))]  # chunks longer than k
        state = np.tile(np.arange(12, dtype=np.uint8), (len(at), 1))
        for k, m in enumerate(live):
            state[:m] = self.goes[state[:m].astype(np.intp) * 10 + classes[at[:m] + k][:, None]]
        back = np.empty(len(at), np.intp)
        back[order] = np.arange(len(at))
        entry = compose_scan(state[back], number == 0)[order]
        cut = np.zeros(len(classes), np.uint8)
        for k, m in enumerate(live):
            step = entry[:m].astype(np.intp) * 10 + classes[at[:m] + k]
            cut[at[:m] + k] = self.cuts[step]
            entry[:m] = self.goes[step]
        ends = np.zeros(len(classes) + 1, bool)
        ends[:-1] = cut & CUT > 0
        ends[:-2] |= cut[1:] & CUT_BEFORE > 0
        ends[first + lengths] = True
        found = np.flatnonzero(ends[1:]) + 1
        return joined, found, np.searchsorted(first, found - 1, side="right") - 1


# ----------------------------------------------------------- piece counter

class PieceCounter:
    """Counts the BPE tokens of one piece by a lazily compiled deterministic transducer."""

    MAX_STATES = 200_000
    MAX_PIECES = 600_000

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        byte_of = {chr(b): b for b in PRINTED}
        byte_of.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(PRINTED))})
        raw = lambda token: bytes(byte_of[c] for c in token)
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(merges)}
        self.tokens = {bytes([b]) for b in range(256)} | {a + b for a, b in self.rank}
        self.made = {a + b: (i, a, b) for (a, b), i in reversed(self.rank.items())}  # the first merge that gives a token
        self.stable: dict[tuple[bytes, bytes], bool] = {}
        self.whole = {bytes([b]) for b in range(256)}
        for a, b in self.rank:  # tokens that their own bytes encode to; the halves come before the whole
            if a in self.whole and b in self.whole and self.made[a + b][1] == a and self._halves(a, b):
                self.whole.add(a + b)
        self.open = {t[:i] for t in self.tokens for i in range(len(t))}  # what a longer token begins with
        self.pieces: dict[str, int] = {}
        self._forget()

    def _forget(self) -> None:
        """Drop compiled states (they are compiled anew when needed); bounds memory, never changes a count."""
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.shapes: dict[bytes, tuple] = {}
        self.moves: dict[int, int] = {}  # state * 256 + byte -> next state * 64 + change + 32
        self._state(b"", ((None, 0),))

    def _state(self, suffix: bytes, ends: tuple) -> int:
        key = (suffix, ends)
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(key)
        return self.ids[key]

    def _halves(self, left: bytes, right: bytes) -> bool:
        """Whether two tokens still stand side by side when their own merge is due."""
        limit = self.rank[left, right]
        while True:
            made_l, made_r = self.made.get(left), self.made.get(right)
            if made_l is None and made_r is None:
                return True
            if made_r is None or made_l is not None and made_l[0] > made_r[0]:
                bound, left = made_l[0], made_l[2]
            else:
                bound, right = made_r[0] + 1, made_r[1]
            if self.rank.get((left, right), 1 << 30) < min(limit, bound):
                return False

    def fits(self, before: bytes | None, token: bytes) -> bool:
        """Whether ``token`` may follow ``before``: no merge across their border comes before the merges that made them.

        The border is followed back in time: the younger of the two tokens is
        undone, and the pair then at the border must not merge earlier than
        the step undone (rules of one rank apply from left to right).
        """
        if before is None:
            return token in self.whole
        known = self.stable.get((before, token))
        if known is None:
            if len(self.stable) > 500_000:
                self.stable.clear()
            left, right, limit, known = before, token, 1 << 30, token in self.whole
            while known:
                if self.rank.get((left, right), limit) < limit:
                    known = False
                    break
                made_l, made_r = self.made.get(left), self.made.get(right)
                if made_l is None and made_r is None:
                    break
                if made_r is None or made_l is not None and made_l[0] > made_r[0]:
                    limit, left = made_l[0], made_l[2]
                else:
                    limit, right = made_r[0] + 1, made_r[1]
            self.stable[before, token] = known
        return known

    def _move(self, state: int, byte: int) -> int:
        """Compile one transition.

        ``ends`` of a state lists (last token, count relative to the newest
        end) for the positions at which the suffix's beginnings start, oldest
        first.
        """
        suffix, ends = self.states[state]
        grown = suffix + bytes([byte])
        shape = self.shapes.get(grown)
        if shape is None:
            cut = next(i for i in range(len(grown) + 1) if grown[i:] in self.open)
            # an end before bytes that begin no longer token is never asked for again
            shape = self.shapes[grown] = ([(i, grown[i:]) for i in range(len(grown)) if grown[i:] in self.tokens],
                                          cut, grown[cut:], [grown[i:] in self.open for i in range(cut, len(grown))])
        candidates, cut, rest, asked = shape
        stable = self.stable
        for i, token in candidates:  # longest first; ends[i] is kept, since what a token begins is open
            before, change = ends[i]
            known = stable.get((before, token))
            if known or known is None and self.fits(before, token):
                change += 1
                break
        else:
            raise ValueError("the merges are not a proper byte-level vocabulary")
        kept = [(e[0], e[1] - change) if a else None for e, a in zip(ends[cut:], asked)]
        kept.append((token, 0))
        packed = self._state(rest, tuple(kept)) * 64 + change + 32
        self.moves[state * 256 + byte] = packed
        return packed

    def count(self, piece: str) -> int:
        n = self.pieces.get(piece)
        if n is None:
            if len(self.states) > self.MAX_STATES:
                self._forget()
            if len(self.pieces) > self.MAX_PIECES:
                self.pieces.clear()
            state = n = 0
            moves = self.moves
            for b in piece.encode("utf-8", "surrogatepass"):
                packed = moves.get(state * 256 + b)
                if packed is None:
                    packed = self._move(state, b)
                state = packed >> 6
                n += (packed & 63) - 32
            if len(piece) <= 64:
                self.pieces[piece] = n
        return n


class TokenCounter:
    """Both transducers, and the vocabulary's special strings, which count as one token wherever they stand."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        pre = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or spec["model"].get("ignore_merges"):
            raise ValueError("a byte-level BPE without normalizer and prefix space is needed")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("special strings that strip their surroundings aren't supported")
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=lambda s: (-len(s), s))
        self.pieces = PieceCounter(spec["model"]["vocab"], merges)
        self.splitter = Splitter()

    def _segments(self, text: str) -> tuple[list[str], int]:
        """The stretches of ordinary text, and the number of special strings between them."""
        segments, special = [text], 0
        for s in self.special:
            if s and any(s in x for x in segments):
                cut = [x.split(s) for x in segments]
                special += sum(len(x) - 1 for x in cut)
                segments = [y for x in cut for y in x]
        return [x for x in segments if x], special

    def counts(self, texts: list[str]) -> np.ndarray:
        total = np.zeros(len(texts), np.int64)
        segments, owner = [], []
        for i, t in enumerate(texts):
            found, special = self._segments(t)
            total[i] += special
            segments += found
            owner += [i] * len(found)
        owner = np.array(owner, np.int64)
        for a, b in in_slices(segments, SLICE_CHARS):
            joined, ends, of = self.splitter.boundaries(segments[a:b])
            stops = ends.tolist()
            known, count = self.pieces.pieces, self.pieces.count
            n = [known.get(p) or count(p) for p in map(joined.__getitem__, map(slice, [0, *stops], stops))]
            total += np.bincount(owner[a:b][of], weights=n, minlength=len(texts)).astype(np.int64)
        return total


def count_tokens(docs: DataFrame, tokenizer_json: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """Add ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) to every row.

    ``tokenizer_json`` is the content of a byte-level BPE definition (a few
    MB, fixed by the vocabulary; sent to the tasks once).  A null or empty
    text has 0 bytes and tokens.  A text is read whole, in chunks of 512
    characters; memory follows the longest text of a batch.  Rows are neither
    dropped nor joined; input columns named like an output are replaced.
    """
    definition = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    return with_outputs(docs.withColumn("_n", token_udf(definition)(F.col(text))), {
        "n_bytes": F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long"),
        "n_tokens": F.col("_n"),
        "over_limit": F.col("_n") > limit,
    }).drop("_n")


_COUNTERS: dict[str, TokenCounter] = {}


def token_udf(definition) -> Column:
    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        spec = definition.value
        if spec not in _COUNTERS:  # compiled states live as long as the worker
            _COUNTERS.clear()
            _COUNTERS[spec] = TokenCounter(spec)
        for batch in batches:
            yield pd.Series(_COUNTERS[spec].counts([t if t is not None else "" for t in batch]))

    return count
