"""Periodic runs against a scan of every period."""

import random
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from quillstack.llm import periods


def plain_runs(words):
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(12, 2 * q) and not any(
                q % d == 0 and all(words[x] == words[x + d] for x in range(i, j + q - d)) for d in range(1, q)
            ):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def stretched(rng):
    """Few-word texts with repeated, nested and damaged stretches."""
    x = [rng.randrange(rng.choice([1, 2, 2, 3, 50])) for _ in range(rng.randrange(1, 150))]
    for _ in range(rng.randrange(4)):
        a = rng.randrange(len(x))
        b = rng.randrange(a, len(x)) + 1
        x = (x[:b] + x[a:b] * rng.randrange(1, 8) + x[b : b + rng.randrange(1, 60)])[:600]
        x[rng.randrange(len(x))] = rng.randrange(4)
    return x


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("first_scale", [0, 1, 3])
def test_runs_match_a_scan_of_every_period(monkeypatch, first_scale):
    monkeypatch.setattr(periods, "FIRST_SCALE", first_scale)
    rng = random.Random(first_scale)
    cases = [stretched(rng) for _ in range(120)] + [fibonacci(n) for n in (1, 12, 90, 377)]
    cases += [[0] * 500, [0, 1] * 200, ([0] * 40 + [1]) * 9, [0, 1] * 20 + [0] + [0, 1] * 20 + [0], list(range(100)) * 2]
    for words in cases:
        got = [(int(s), int(e - s), int(q)) for s, e, q in periods.find_runs(np.array(words, np.int32))]
        assert got == plain_runs(words)


def sha(text):
    return sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped).decode()
    milli = 1000 * top[1] // top[2] if runs else None
    return (doc_id, len(runs), *top, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(kept))


def test_query_matches_a_scan_of_every_period(docs):
    short = docs.where("length(text) < 5000")
    got = Counter(tuple(r) for r in periods.query(short).collect())
    want = Counter(expected(r["doc_id"], r["text"]) for r in short.collect())
    assert got == want and any(r[1] for r in want)


def test_odd_rows(odd, empty):
    got = Counter(tuple(r) for r in periods.query(odd).collect())
    short = odd.where("text is null or length(text) < 100000")
    want = Counter(expected(r["doc_id"], r["text"]) for r in short.collect())
    assert all(got[k] >= n for k, n in want.items())
    (long,) = [r for r in got if r[0] == 7]
    assert long[3] == 30_000 and long[4] == 1 and sum(got.values()) == odd.count()
    assert periods.query(empty).collect() == []


def test_runs_do_not_cross_texts_and_texts_are_whole(spark):
    words = " ".join(f"w{i}" for i in range(70_000))
    rows = [(i, t) for i, t in enumerate(["x " * 8, "x " * 8, words + " " + words])]
    got = {r["doc_id"]: r for r in periods.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i]["n_runs"] for i in (0, 1)] == [0, 0]
    assert (got[2]["start"], got[2]["length"], got[2]["period"]) == (0, 140_000, 70_000)
    assert got[2]["collapsed_sha256"] == sha(words)
