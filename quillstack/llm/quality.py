"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature is cut into bins; boosting cycles over the features and fits, to the current residuals,
a tree of a few leaves on one feature at a time, whose steps add up to one lookup table per feature.
The strongest pairs of features then get small two-way tables in the same way. A score is the sum of
looked-up values, so scoring is a few table look-ups over whole batches.

Features and scores are computed by Spark over all documents, in slices of bounded length. The model
is fitted on the driver from at most `FIT_ROWS` labelled feature rows, chosen by a hash of the id;
that bound is a parameter. Labels, language, source and id are no features.

Null texts are empty texts, and empty texts are scored like all others. Null ids stay null and count
as held out; repeated rows are scored alike; extra columns are ignored. With no labels, or labels of
one kind, every score is the smoothed share of label 1.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstack.llm.common import mapped

FIT_ROWS = 20_000
THRESHOLD = 0.3
FOLDS = 5

FEATURES = (
    "words", "chars_per_word", "lines", "chars_per_line", "upper", "digits", "symbols", "bars", "stops",
    "commas", "bangs", "distinct_words", "repeated_lines", "top_word", "short_words", "long_words",
)

SYMBOLS = np.frombuffer(b"#*$%&<>", np.uint8)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def text_features(text: str) -> tuple[float, ...]:
    """Feature values of one text; sums over its bytes and its words."""
    words = text.split()
    n = max(len(words), 1)
    bytes_ = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    shown = max(int(bytes_[33:].sum()), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    n_lines = max(len(lines), 1)
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    lower = max(int(bytes_[97:123].sum()), 1)
    return (
        np.log1p(len(words)), len(text) / n, np.log1p(len(lines)), len(text) / n_lines,
        bytes_[65:91].sum() / lower, bytes_[48:58].sum() / shown, bytes_[SYMBOLS].sum() / shown,
        bytes_[124] / n, bytes_[46] / n, bytes_[44] / n, bytes_[33] / n,
        len(counts) / n, 1 - len(set(lines)) / n_lines if lines else 0.0, max(counts.values(), default=0) / n,
        float((lengths <= 3).sum()) / n, float((lengths >= 12).sum()) / n,
    )


def features(docs: DataFrame) -> DataFrame:
    """`doc_id, x` with `x` the feature values of every row of `docs (doc_id, text)`."""

    def work(ids: list, texts: list) -> dict:
        return {"doc_id": ids, "x": [list(map(float, text_features(t))) for t in texts]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(docs.select("doc_id", "text"), work, f"doc_id {kind}, x array<double>")


@dataclass
class Additive:
    """Lookup tables: `edges` per feature, `mains` per feature, `pairs` of (i, j, table)."""

    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    mains: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for edges, table, column in zip(self.edges, self.mains, x.T, strict=True):
            z += table[np.searchsorted(edges, column, side="right")]
        for i, j, table in self.pairs:
            z += table[
                np.searchsorted(self.coarse[i], x[:, i], side="right"),
                np.searchsorted(self.coarse[j], x[:, j], side="right"),
            ]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) if len(column) else np.empty(0)


def _step(code: np.ndarray, size: int, grad: np.ndarray, hess: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """One shallow tree on one binned feature, as a value per bin: the best cut, then the best cut of a side."""
    g, h = np.bincount(code, grad, size), np.bincount(code, hess, size)
    parts = [(0, size)]
    gain_of = lambda a, b: a * a / (b + ridge)
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for k, (lo, hi) in enumerate(parts):
            if hi - lo < 2:
                continue
            left_g, left_h = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
            all_g, all_h = g[lo:hi].sum(), h[lo:hi].sum()
            gains = gain_of(left_g, left_h) + gain_of(all_g - left_g, all_h - left_h) - gain_of(all_g, all_h)
            at = int(np.argmax(gains))
            if gains[at] > best[0]:
                best = (gains[at], k, lo + at + 1)
        if best[1] is None:
            break
        lo, hi = parts.pop(best[1])
        parts += [(lo, best[2]), (best[2], hi)]
    out = np.zeros(size)
    for lo, hi in parts:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + ridge)
    return out


def fit(
    x: np.ndarray, y: np.ndarray, cycles: int = 60, rate: float = 0.15, bins: int = 64, coarse: int = 8,
    n_pairs: int = 6, leaves: int = 3, ridge: float = 4.0,
) -> Additive:
    """Cyclic boosting of single features, then of the `n_pairs` pairs that explain most of what is left."""
    share = (y.sum() + 1) / (len(y) + 2)
    d = x.shape[1] if x.ndim == 2 else len(FEATURES)
    model = Additive(float(np.log(share / (1 - share))))
    model.edges = [_cuts(x[:, i], bins) if len(x) else np.empty(0) for i in range(d)]
    model.coarse = [_cuts(x[:, i], coarse) if len(x) else np.empty(0) for i in range(d)]
    model.mains = [np.zeros(len(e) + 1) for e in model.edges]
    if len(y) == 0 or y.min() == y.max():
        return model
    codes = [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(model.edges)]
    z = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(cycles):
        for i in range(d):
            step = rate * _step(codes[i], len(model.mains[i]), *slopes(), leaves, ridge)
            model.mains[i] += step
            z += step[codes[i]]
    small = [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(model.coarse)]
    size = [len(e) + 1 for e in model.coarse]
    grad, hess = slopes()
    gains = []
    for i in range(d):
        for j in range(i + 1, d):
            both = small[i] * size[j] + small[j]
            g, h = np.bincount(both, grad, size[i] * size[j]), np.bincount(both, hess, size[i] * size[j])
            gains.append((float((g * g / (h + ridge)).sum()), i, j))
    model.pairs = [(i, j, np.zeros((size[i], size[j]))) for _, i, j in sorted(gains, reverse=True)[:n_pairs]]
    for _ in range(cycles // 2):
        for i, j, table in model.pairs:
            both = small[i] * size[j] + small[j]
            grad, hess = slopes()
            g, h = np.bincount(both, grad, table.size), np.bincount(both, hess, table.size)
            step = (rate * g / (h + ridge)).reshape(table.shape)
            table += step
            z += step[small[i], small[j]]
    return model


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Additive:
    """The model from labelled rows outside the held-out fold; at most `fit_rows` of them, by a hash of the id.

    The rows are chosen from the labels alone, so only their documents' features are computed.
    """
    chosen = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = chosen.select("doc_id", F.col("quality").alias("_quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "_quality").limit(fit_rows)
    wanted = docs.select("doc_id", "text").join(chosen.select("doc_id").distinct(), "doc_id", "left_semi")
    rows = features(wanted).join(chosen, "doc_id").orderBy("doc_id", "_quality").limit(fit_rows).collect()
    x = np.array([r["x"] for r in rows], dtype=float).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([float(r["_quality"]) for r in rows]))


def score(docs: DataFrame, model: Additive) -> DataFrame:
    """`doc_id, score` of every row of `docs (doc_id, text)`."""

    def work(ids: list, texts: list) -> dict:
        x = np.array([text_features(t) for t in texts], dtype=float).reshape(len(texts), len(FEATURES))
        return {"doc_id": ids, "score": model.score(x)}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(docs.select("doc_id", "text"), work, f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, model: Additive, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` without the rows that score below the threshold; all columns stay.

    Rows pass through Python as they are, so nothing is joined.
    """
    fields = docs.schema
    at = fields.names.index("text")

    def run(batches):
        for batch in batches:
            x = np.array([text_features(t or "") for t in batch.column(at).to_pylist()], dtype=float)
            good = model.score(x.reshape(batch.num_rows, len(FEATURES))) >= threshold
            import pyarrow as pa

            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, fields)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels)
    rows = score(docs, model)
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
