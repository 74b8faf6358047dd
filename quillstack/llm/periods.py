"""Periodic runs of words: multi-scale minimizers seed long periods, lag scans cover short ones.

A run is a maximal stretch of words that repeats with its smallest period q and is at least
max(`MIN_WORDS`, 2q) words long. Words become numbers, and the texts of a slice stand in one array
with a mark of its own between them, which no run can cross.

Periods under 2 * 2**FIRST_SCALE: for every lag, the stretches in which words that far apart agree.
Longer periods: at scale s, with K = 2**s, every window of K neighbouring K-grams marks its least one
(by a scramble of the K-gram's rank; the leftmost of equal ones). A period q of 2K to 4K - 1 has a whole
window in its first copy, and the same window q words later marks the same K-gram, so some pair of
equal marked K-grams stands q apart. Equal K-grams that overlap by half or more lie in one run of a
shorter period and form a progression; distances within it are no smallest periods, and between two
progressions each distance is tried once, so the pairs stay in proportion to the words. Every pair is
extended both ways by ranks of 8**k-grams; the stretches that are long enough and have no shorter
period, which the prime divisors of q decide, are the runs. So every run is found, and each once.

Null and empty texts have no words and no runs. Texts are never cut; a slice of texts is held as
numbers (about 40 bytes a word), a text longer than a slice by itself. Each row is worked on for
itself: repeated rows give repeated results, rows without an id are never changed by `planted`.
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from hashlib import sha256
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from quillstack.llm.common import mapped, mix64

MIN_WORDS = 12
#: Periods under 2 * 2**FIRST_SCALE are found by lag scans.
FIRST_SCALE = 3
#: Steps of the extension: 8**0 up to 8**LONGEST_STEP words at a time.
LONGEST_STEP = 4
PIECE_BYTES = 1 << 20
GAP = re.compile(rb"[ \t-\r]")


class Numbers(dict):
    """Numbers words in the order they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def coded(text: str, numbers: Numbers, change: Callable[[bytes], bytes] = bytes) -> np.ndarray:
    """The numbers of a text's words, which are split piece by piece; `change` is applied to the pieces."""
    raw, at, parts = text.encode("utf-8", "replace"), 0, [np.empty(0, np.int32)]
    while at < len(raw):
        gap = GAP.search(raw, at + PIECE_BYTES)
        end = gap.start() if gap else len(raw)
        piece = change(raw[at:end]).split()
        parts.append(np.fromiter(map(numbers.__getitem__, piece), np.int32, len(piece)))
        at = end
    return np.concatenate(parts)


def repeated(values: np.ndarray) -> np.ndarray:
    """Equal numbers for equal values, -1 for values that occur once."""
    numbers = pd.factorize(values)[0].astype(np.int32)
    return np.where(np.bincount(numbers)[numbers] > 1, numbers, np.int32(-1)) if len(numbers) else numbers


class Ranks:
    """Numbers of the word runs of length 8**k at every place, equal for equal runs, -1 for what occurs once."""

    def __init__(self, codes: np.ndarray):
        self.last, self.length = repeated(codes), 1
        self.steps = {1: self.last}

    def double(self) -> None:
        """`last` becomes the ranks of runs twice as long; places without a whole run drop out."""
        k = self.length
        first, second = (self.last[:-k], self.last[k:]) if k < len(self.last) else (self.last[:0], self.last[:0])
        both = np.flatnonzero((first >= 0) & (second >= 0))  # only these can occur again
        pairs = first[both].astype(np.int64) * (int(second.max(initial=0)) + 1) + second[both]
        self.last = np.full(len(first), -1, np.int32)
        self.last[both] = repeated(pairs)
        self.length = 2 * k
        if self.length in (8**s for s in range(LONGEST_STEP + 1)):
            self.steps[self.length] = self.last

    def agree(self, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
        """How many words agree from places `a` and `b` (a < b) on, or before them."""
        count = np.zeros(len(a), np.int64)
        for length in sorted(self.steps, reverse=True):
            table, live = self.steps[length], np.arange(len(a))
            while len(live):
                x, y = (a[live] + count[live], b[live] + count[live]) if forward else (
                    a[live] - count[live] - length, b[live] - count[live] - length
                )
                inside = (x >= 0) & (y < len(table))
                live, x, y = live[inside], x[inside], y[inside]
                live = live[(table[x] == table[y]) & (table[x] >= 0)]
                count[live] += length
        return count


def stretches(codes: np.ndarray, lag: int) -> np.ndarray:
    """(start, end, lag) of the maximal stretches whose words `lag` apart agree, if two periods long or more."""
    same = np.r_[False, codes[lag:] == codes[:-lag], False]
    edges = np.flatnonzero(same[1:] != same[:-1])
    begin, end = edges[::2], edges[1::2] + lag
    long = end - begin >= max(MIN_WORDS, 2 * lag)
    return np.stack([begin[long], end[long], np.full(long.sum(), lag)], 1)


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Places that hold the leftmost least key of some window of `width` (a power of two) places."""
    if len(keys) < width:
        return np.empty(0, np.int64)
    at = np.arange(len(keys))
    reach = 1
    while reach < width:
        left, right = at[:-reach], at[reach:]
        at = np.where(keys[right] < keys[left], right, left)
        reach *= 2
    return np.unique(at)


def seeds(ranks: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) pairs of equal minimizers `2K` to `4K - 1` apart."""
    size = 1 << scale
    none = np.empty(0, np.int64)
    # A window in the first copy holds only K-grams that occur again, so the others need no place here.
    place = np.flatnonzero(ranks >= 0)
    marked = place[window_minima(mix64(ranks[place].astype(np.uint64) + np.uint64(1)), size)]
    if not len(marked):
        return none, none
    # All places of the marked K-grams, grouped by K-gram.
    again = np.zeros(int(ranks.max()) + 1, bool)
    again[ranks[marked]] = True
    place = place[again[ranks[place]]]
    place = place[np.argsort(ranks[place], kind="stable")]
    value = ranks[place]
    # Progressions: equal K-grams at most K/2 apart.
    opens = np.r_[True, (value[1:] != value[:-1]) | (np.diff(place) > size // 2)]
    group = np.cumsum(opens) - 1
    heads = np.flatnonzero(opens)
    first, of = place[heads], value[heads]
    kept = np.zeros(len(heads), bool)
    is_marked = np.zeros(len(ranks), bool)
    is_marked[marked] = True
    kept[group[is_marked[place]]] = True
    found = []
    for step in (1, -1):  # each place with the first place of later progressions, and with that of earlier ones
        live, other = np.arange(len(place)), group + step
        while len(live):
            inside = (other[live] >= 0) & (other[live] < len(heads))
            live = live[inside]
            there = other[live]
            apart = np.abs(first[there] - place[live])
            # Places stand in order within a K-gram: once too far, always too far.
            near = (of[there] == value[live]) & (apart < 4 * size)
            live, there, apart = live[near], there[near], apart[near]
            good = (apart >= 2 * size) & kept[there] & kept[group[live]]
            found.append(np.stack([np.minimum(place[live], first[there])[good], apart[good]], 1))
            other[live] += step
    pairs = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64)
    return pairs[:, 0], pairs[:, 1]


def smallest(ranks: Ranks, runs: np.ndarray) -> np.ndarray:
    """Which of the stretches (start, end, period) have no shorter period: none of q / prime."""
    good = np.ones(len(runs), bool)
    rest = runs[:, 2].copy()
    start, length, period = runs[:, 0], runs[:, 1] - runs[:, 0], runs[:, 2]
    prime = 2
    while len(open_ := np.flatnonzero(rest > 1)):
        if prime * prime > rest.max():
            primes = rest[open_]  # what is left is prime
        else:
            open_ = open_[rest[open_] % prime == 0]
            primes = np.full(len(open_), prime)
        shorter = period[open_] // primes
        agree = ranks.agree(start[open_], start[open_] + shorter, True)
        good[open_[agree >= length[open_] - shorter]] = False
        if prime * prime > rest.max():
            break
        while len(open_):
            rest[open_] //= prime
            open_ = open_[rest[open_] % prime == 0]
        prime += 1
    return good


def find_runs(codes: np.ndarray) -> np.ndarray:
    """All runs (start, end, period) of an array of word numbers, by start, then period."""
    ranks = Ranks(codes)
    first = 2 << FIRST_SCALE
    found = [stretches(codes, lag) for lag in range(1, min(first, len(codes)))]
    for _ in range(FIRST_SCALE):
        ranks.double()
    for scale in range(FIRST_SCALE, 63):
        if ranks.last.max(initial=-1) < 0:
            break  # no run of so many words occurs twice
        place, period = seeds(ranks.last, scale)
        if len(place):
            begin = place - ranks.agree(place, place + period, False)
            end = place + period + ranks.agree(place, place + period, True)
            long = end - begin >= np.maximum(MIN_WORDS, 2 * period)
            found.append(np.unique(np.stack([begin, end, period], 1)[long], axis=0))
        ranks.double()
    runs = np.concatenate(found) if found else np.empty((0, 3), np.int64)
    runs = runs[smallest(ranks, runs)]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def planted(doc_id, n: int) -> np.ndarray:
    """Which original word stands at each of `n` places: one document in ten gets a period of its own."""
    order = np.arange(n)
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return order
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order[a:] = a + (order[a:] - a) % p
    return order


def collapsed(names: list[bytes], codes: np.ndarray) -> str:
    """Digest of the words joined by one space."""
    out = sha256()
    for at in range(0, len(codes), PIECE_BYTES):
        out.update((b" " if at else b"") + b" ".join([names[c] for c in codes[at : at + PIECE_BYTES].tolist()]))
    return out.hexdigest()


SCHEMA = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


def described(ids: list, texts: list[str], placed: Callable[[object, int], np.ndarray] | None) -> dict:
    """Columns of `SCHEMA` for some texts; `placed` deals their words anew before they are searched."""
    names = Numbers()
    parts, sizes = [], []
    for doc_id, text in zip(ids, texts, strict=True):
        codes = coded(text, names)
        parts.append(codes[placed(doc_id, len(codes))] if placed else codes)
        sizes.append(len(codes))
    marks = np.arange(len(names), len(names) + len(texts), dtype=np.int32)
    codes = np.concatenate([x for part, mark in zip(parts, marks, strict=True) for x in (part, [mark])]).astype(np.int32)
    starts = np.cumsum([0, *[s + 1 for s in sizes]])
    runs = find_runs(codes)
    # A word goes that stands after the first period of a run.
    turns = np.zeros(len(codes) + 1, np.int64)
    np.add.at(turns, runs[:, 0] + runs[:, 2], 1)
    np.add.at(turns, runs[:, 1], -1)
    kept = np.cumsum(turns[:-1]) == 0
    owner = np.searchsorted(starts, runs[:, 0], side="right") - 1
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    inverse = list(names)
    out: dict[str, list] = {f.split()[0]: [] for f in SCHEMA.split(", ")}
    for k, doc_id in enumerate(ids):
        lo, hi = starts[k], starts[k] + sizes[k]
        own = runs[cuts[k] : cuts[k + 1]]
        listed = [(int(s - lo), int(e - s), int(q)) for s, e, q in own]
        start, length, period = min(listed, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in listed)
        out["doc_id"].append(doc_id)
        out["n_runs"].append(len(listed))
        out["start"].append(start)
        out["length"].append(length)
        out["period"].append(period)
        out["exponent_milli"].append(1000 * length // period if listed else None)
        out["runs_sha256"].append(sha256(lines.encode()).hexdigest())
        out["collapsed_sha256"].append(collapsed(inverse, codes[lo:hi][kept[lo:hi]]))
    return out


def periodic_runs(docs: DataFrame, placed: Callable[[object, int], np.ndarray] | None = None) -> DataFrame:
    """Columns of `SCHEMA` for every row of `docs (doc_id, text)`."""
    rows = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return mapped(rows, lambda ids, texts: described(ids, texts, placed), SCHEMA)


def query(docs: DataFrame) -> DataFrame:
    return periodic_runs(docs, planted)
