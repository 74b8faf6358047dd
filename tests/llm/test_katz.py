"""Katz backoff against a plain model of dictionaries on the driver."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quillstack.llm import katz
from quillstack.sources.workspace import Workspace


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def learned(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 != 0


class Plain:
    """The same model, all in memory; n-grams are (context, word) with None before a text."""

    def __init__(self, texts, order):
        self.order, self.counts = order, [Counter() for _ in range(order)]
        for text in texts:
            words = [None] * (order - 1) + tokens(text)
            for i in range(order - 1, len(words)):
                for n in range(order):
                    self.counts[n][(tuple(words[i - n : i]), words[i])] += 1
        self.after = [defaultdict(dict) for _ in range(order)]
        self.factors = []
        for n in range(order):
            for (context, word), c in self.counts[n].items():
                self.after[n][context][word] = c
            sizes = Counter(self.counts[n].values())
            self.factors.append(katz.discounts([sizes[r] for r in range(1, katz.FLAT + 2)]))
        self.weights = [{} for _ in range(order)]
        self.masses = {}

    def mass(self, n, context):
        if context not in self.masses:
            self.masses[context] = self.left(n, context)
        return self.masses[context]

    def left(self, n, context):
        counts = self.after[n][context].values()
        freed = sum(c * (1 - self.factors[n][c - 1]) for c in counts if c <= katz.FLAT)
        total = sum(counts)
        return (total, freed / total) if freed > 0 else (total + 1, 1 / (total + 1))

    def p(self, context, word):
        n = len(context)
        seen = self.after[n].get(context, {})
        if not seen and n:
            return self.p(context[1:], word)
        divisor, mass = self.mass(n, context)
        if word in seen:
            c = seen[word]
            return c * (self.factors[n][c - 1] if c <= katz.FLAT else 1) / divisor
        if not n:
            return mass
        if context not in self.weights[n]:
            self.weights[n][context] = mass / (1 - sum(self.p(context[1:], w) for w in seen))
        return self.weights[n][context] * self.p(context[1:], word)

    def score(self, text):
        words = [None] * (self.order - 1) + tokens(text)
        return sum(math.log10(self.p(tuple(words[i - self.order + 1 : i]), words[i])) for i in range(self.order - 1, len(words)))


def check(rows, got, order):
    train = [r["text"] for r in rows if learned(r["doc_id"])]
    plain, unigrams = Plain(train, order), Counter(w for t in train for w in tokens(t))
    total = sum(unigrams.values())
    base = lambda w: math.log10((unigrams[w] + 0.1) / (total + 0.1 * (len(unigrams) + 1)))
    want = []
    for r in rows:
        words = tokens(r["text"])
        known = sum(unigrams[w] > 0 for w in words)
        want.append((r["doc_id"], not learned(r["doc_id"]), len(words), known, total, sum(map(base, words)), plain.score(r["text"])))
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert tuple(a)[:5] == b[:5]
        assert (a[5], a[6]) == (pytest.approx(b[5], rel=1e-9), pytest.approx(b[6], rel=1e-6))
    return plain


COLUMNS = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@pytest.mark.parametrize("order,sizes", [(1, (2000, 5000)), (2, (3000, 4000)), (3, (5000, 9000)), (2, (10**6, 10**6))])
def test_scores_match_a_plain_model(spark, docs, order, sizes):
    """Small slices and buckets deal hot contexts over several buckets."""
    rows = docs.collect()
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    model = katz.train(docs.repartition(3), Workspace(spark), ~held_out, order, *sizes)
    got = katz.scored(model, "bigint").withColumn("held_out", ~F.col("train")).select(*COLUMNS).collect()
    check(rows, [tuple(r) for r in got], order)


def test_every_context_sums_to_one(docs):
    plain = Plain([r["text"] for r in docs.limit(60).collect()], 3)
    vocabulary = [w for _, w in plain.counts[0]]
    contexts = [(), *list(plain.after[1])[:20], *list(plain.after[2])[:20], (b"never", b"seen")]
    for context in contexts:
        unseen = plain.p(context, b"not a word")
        assert unseen > 0 and sum(plain.p(context, w) for w in vocabulary) + unseen == pytest.approx(1, abs=1e-9)


def test_discounts():
    # 100 singletons, 40, 20, 12, 8, 6: r* = (r + 1) n(r+1) / n(r), and the share that keeps the sum right.
    share = 6 * 6 / 100
    want = [((r + 1) * b / (r * a) - share) / (1 - share) for r, (a, b) in enumerate(zip([100, 40, 20, 12, 8], [40, 20, 12, 8, 6]), 1)]
    got = katz.discounts([100, 40, 20, 12, 8, 6]).tolist()
    assert got == pytest.approx(want) if all(0 < w < 1 for w in want) else got[4] == 1
    assert katz.discounts([0] * 6).tolist() == [0.5, 1, 1, 1, 1]


def test_odd_rows(odd, empty):
    got = [tuple(r) for r in katz.query(odd).select(*COLUMNS).collect()]
    check(odd.collect(), got, katz.ORDER)
    assert katz.query(empty).collect() == []


def test_nothing_to_learn_from(spark, docs):
    model = katz.train(docs.limit(5), Workspace(spark), F.lit(False))
    for r in katz.scored(model, "bigint").collect():
        assert (r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (0, 0, 0.0, 0.0)
