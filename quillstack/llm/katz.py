"""Katz backoff language model: Good-Turing discounted n-gram counts, exactly normalised backoff weights.

The probability of a token after a context is its discounted relative frequency if the corpus has
the two together, else the context's backoff weight times the probability after the context without
its first token; after no context, an unseen token has the mass that the unigram discounts leave
(all unseen words are one type). A weight is the mass the context's discounts leave, divided by the
exact sum of the shorter context's probabilities over the tokens not seen there, so that every
context's probabilities sum to one. Counts up to `FLAT` are discounted by Good-Turing, in each order
by its own counts of counts; where these allow no discount under 1, fewer counts are discounted, at
last only 1, by half. A context without any mass left has one more count, which is that mass.

How it runs. Texts become slices of about `SLICE_TOKENS` tokens, written once, bucketed by slice: word
digests and every token's word number. Order by order, each slice sends its distinct n-grams to buckets
by their context; a context with more tokens than a bucket's share is dealt over several buckets by
the n-gram's last word, and what the buckets sum per context is added up by the slices. A bucket adds
up the counts and answers every slice with the corpus counts of its n-grams and the sums of its
contexts. These answers are the model: one table per order, by bucket and slice. The last step scores
every token recursively from them. So an n-gram crosses the network once per slice and order, however
frequent, texts and token streams never do, and the driver sees only counts of counts.

Words are told apart by 64-bit digests. Null and empty texts are their end token. Rows without a
doc_id are learned from and are not held out; repeated rows count and are scored each for itself.
Extra columns are ignored; an empty table gives an empty result, and without rows to learn from
every token is an unseen one of probability 1.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstack.llm.common import mix64
from quillstack.llm.periods import Numbers, coded
from quillstack.sources.workspace import Workspace

ORDER = 2
FLAT = 5
SLICE_TOKENS = 1 << 20
BUCKET_TOKENS = 1 << 21
STEP = np.uint64(0x9E3779B97F4A7C15)
#: Digests of the empty context and of the place before a text's first token.
ROOT, START = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9FB21C651E98DF25)
END = b""


def pack(values: np.ndarray) -> bytes:
    """An array compressed by byte planes: all first bytes, all second bytes and so on."""
    raw = values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def unpack(data: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    raw = pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""
    planes = np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


# --- slices ---------------------------------------------------------------------------------------


def sliced(docs: DataFrame, trained: Column, slice_tokens: int) -> DataFrame:
    """`slice, ids, train, sizes, words, codes, n_tokens, n_docs`: the rows of `docs` with their tokens as numbers."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.coalesce(trained, F.lit(True)).alias("train"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"slice bigint, ids array<{kind}>, train array<boolean>, sizes array<int>, words binary, codes binary, "
        "n_tokens bigint, n_docs bigint"
    )
    fields = docs.sparkSession.createDataFrame([], schema).schema

    def emit(turn: int, ids: list, train: list, parts: list, numbers: Numbers) -> pa.RecordBatch:
        from pyspark.sql.pandas.types import to_arrow_schema

        words = np.array(list(numbers), dtype=object)
        codes = np.concatenate(parts)
        row = {
            "slice": TaskContext.get().partitionId() * 2**32 + turn, "ids": ids, "train": train,
            "sizes": [len(p) for p in parts], "words": pack(pd.util.hash_array(words)), "codes": pack(codes),
            "n_tokens": len(codes), "n_docs": sum(train),
        }
        return pa.RecordBatch.from_pylist([row], schema=to_arrow_schema(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, held = 0, 0
        ids, train, parts, numbers = [], [], [], Numbers()
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(3)]
            for doc_id, text, learned in zip(*columns, strict=True):
                # Lower-casing bytes changes A to Z only.
                codes = np.r_[coded(text or "", numbers, bytes.lower), np.int32(numbers[END])]
                ids.append(doc_id)
                train.append(learned)
                parts.append(codes)
                held += len(codes)
                if held >= slice_tokens:
                    yield emit(turn, ids, train, parts, numbers)
                    turn, held = turn + 1, 0
                    ids, train, parts, numbers = [], [], [], Numbers()
        if ids:
            yield emit(turn, ids, train, parts, numbers)

    return rows.mapInArrow(run, fields)


def kept_by_slice(ws: Workspace, df: DataFrame) -> DataFrame:
    """The slices as a written table bucketed by slice, so that answers come to them and they stay."""
    spark, name = df.sparkSession, f"quillstack_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, "slice").option("path", ws.path("slices")).saveAsTable(name, format="parquet")
    return spark.table(name)


@dataclass
class Level:
    """The distinct n-grams of one order in a slice; `ids` names every token's."""

    ids: np.ndarray
    word: np.ndarray  # of each n-gram: its last word
    context: np.ndarray  # the n-gram of the order below without the last word; the last number is a text's start
    low: np.ndarray  # the n-gram of the order below without the first word
    digest: np.ndarray
    context_digest: np.ndarray
    trained: np.ndarray  # times it stands in the slice's texts to learn from
    count: np.ndarray = field(default_factory=lambda: np.empty(0))  # from here on: what the buckets answered
    total: np.ndarray = field(default_factory=lambda: np.empty(0))  # by context
    below: np.ndarray = field(default_factory=lambda: np.empty(0))
    few: np.ndarray = field(default_factory=lambda: np.empty(0))


class Slice:
    def __init__(self, row: pd.Series, order: int):
        self.codes = unpack(row["codes"], np.int32)
        self.sizes = np.array(row["sizes"], np.int64)
        self.ids, train = list(row["ids"]), np.array(row["train"], bool)
        words = unpack(row["words"], np.uint64)
        learned = np.repeat(train, self.sizes)
        self.first = np.cumsum(self.sizes) - self.sizes
        n = len(words)
        tally = lambda ids, size: np.bincount(ids[learned], minlength=size)
        none = np.zeros(n, np.int64)
        self.levels = [Level(self.codes, np.arange(n), none, none, words, np.array([ROOT]), tally(self.codes, n))]
        for _ in range(order - 1):
            last = self.levels[-1]
            size = len(last.word)
            context = np.r_[size, last.ids[:-1]].astype(np.int64)
            context[self.first] = size
            grams, place, ids = np.unique(context * n + self.codes, return_index=True, return_inverse=True)
            context_digest = np.r_[last.digest, START]
            word, context = grams % n, grams // n
            digest = mix64(context_digest[context] * STEP + words[word])
            self.levels.append(Level(ids, word, context, last.ids[place], digest, context_digest, tally(ids, len(grams))))

    def context_counts(self, k: int, tokens: int, texts: int) -> np.ndarray:
        """How often the contexts of order k + 1 were learned from."""
        return np.array([tokens]) if k == 0 else np.r_[self.levels[k - 1].count, texts].astype(np.int64)

    def dealt(self, k: int, tokens: int, texts: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """N-grams of order k + 1 and their buckets, contexts and their buckets; each by bucket, then context."""
        level = self.levels[k]
        share = max(1, tokens // buckets)
        parts = -(-self.context_counts(k, tokens, texts) // share)
        at = lambda context, part: (mix64(level.context_digest[context]) + part.astype(np.uint64)) % np.uint64(buckets)
        grams = np.flatnonzero(parts[level.context] > 0)
        context = level.context[grams]
        part = mix64(self.levels[0].digest)[level.word[grams]] % parts[context].astype(np.uint64)
        bucket = at(context, part).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        heads = np.repeat(np.arange(len(parts)), parts)
        number = np.arange(len(heads)) - np.repeat(np.cumsum(parts) - parts, parts)
        pairs = np.unique(at(heads, number).astype(np.int64) * len(parts) + heads)
        return grams[order], bucket[order], pairs % len(parts), pairs // len(parts)

    def answered(self, k: int, rows: pd.DataFrame, tokens: int, texts: int, buckets: int) -> None:
        """Take the answers of all buckets to the request of order k + 1."""
        level = self.levels[k]
        grams, _, heads, _ = self.dealt(k, tokens, texts, buckets)
        rows = rows[rows["level"] == k].sort_values("bucket")
        joined = lambda c, t: np.concatenate([unpack(x, t) for x in rows[c]]) if len(rows) else np.empty(0, t)
        level.count = np.zeros(len(level.word), np.int64)
        level.count[grams] = joined("counts", np.uint32)
        size = len(level.context_digest)
        level.total = np.bincount(heads, joined("totals", np.uint64), size)
        level.below = np.bincount(heads, joined("below", np.float64), size)
        few = joined("few", np.uint32).reshape(-1, FLAT)
        level.few = np.stack([np.bincount(heads, few[:, r], size) for r in range(FLAT)], 1)


# --- discounts and weights ------------------------------------------------------------------------


def discounts(counts: list[int]) -> np.ndarray:
    """What is left of counts 1 to `FLAT`, as factors, from the numbers of n-grams that occur 1 to `FLAT` + 1 times."""
    out = np.ones(FLAT)
    n = [0, *counts]
    for k in range(FLAT, 0, -1):
        if min(n[1 : k + 2]) <= 0:
            continue
        share = (k + 1) * n[k + 1] / n[1]
        if share >= 1:
            continue
        found = [((r + 1) * n[r + 1] / (r * n[r]) - share) / (1 - share) for r in range(1, k + 1)]
        if all(0 < d < 1 for d in found):
            out[:k] = found
            return out
    out[0] = 0.5
    return out


def discounted(count: np.ndarray, factors: np.ndarray) -> np.ndarray:
    return count * np.r_[1.0, factors, 1.0][np.minimum(count, FLAT + 1)]


def left_over(total: np.ndarray, few: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per context: the divisor of its discounted counts, and the mass they leave."""
    freed = few @ ((1 - factors) * np.arange(1, FLAT + 1))
    divisor = np.where(freed > 0, total, total + 1)
    return divisor, np.where(freed > 0, freed, 1.0) / divisor


def log_probabilities(levels: list[Level], factors: list[np.ndarray]) -> np.ndarray:
    """log10 probability of every n-gram of the highest order, order by order from below."""
    below = np.zeros(1)
    for level, left in zip(levels, factors, strict=True):
        divisor, mass = left_over(level.total, level.few, left)
        weight = np.where(level.total > 0, mass / np.maximum(1 - level.below, 1e-12), 1.0)
        if len(level.context_digest) == 1:
            weight = mass  # the unigrams' mass is that of the unseen words
        seen = discounted(level.count, left) / divisor[level.context]
        with np.errstate(divide="ignore"):
            below = np.where(level.count > 0, np.log10(seen), np.log10(weight)[level.context] + below[level.low])
    return below


# --- the exchange ---------------------------------------------------------------------------------

REQUEST = "bucket bigint, slice bigint, heads binary, sizes binary, divisors binary, names binary, words binary, trained binary, low binary"
ANSWER = "slice bigint, level int, bucket bigint, counts binary, totals binary, below binary, few binary, n_counts array<bigint>, total bigint, distinct bigint"


def requests(part: Slice, k: int, slice_id: int, factors: list[np.ndarray], tokens: int, texts: int, buckets: int) -> pd.DataFrame:
    """What a slice asks of every bucket about its n-grams of order k + 1; columns of `REQUEST`."""
    level, out = part.levels[k], []
    grams, bucket, heads, head_bucket = part.dealt(k, tokens, texts, buckets)
    divisor = np.ones(len(level.context_digest))
    low = np.zeros(len(level.word), np.int64)
    if k:
        under = part.levels[k - 1]
        low = under.count[level.low]
        divisor[level.context] = left_over(under.total, under.few, factors[k - 1])[0][under.context[level.low]]
    digests = part.levels[0].digest
    for b in np.unique(head_bucket).tolist():
        own = grams[slice(*np.searchsorted(bucket, [b, b + 1]))]
        head = heads[slice(*np.searchsorted(head_bucket, [b, b + 1]))]
        ends = np.searchsorted(level.context[own], head, side="right")
        names, words = np.unique(level.word[own], return_inverse=True)
        out.append((
            b, slice_id, pack(level.context_digest[head]), pack(np.diff(np.r_[0, ends]).astype(np.uint32)),
            pack(divisor[head]), pack(digests[names]), pack(words.astype(np.uint32)),
            pack(level.trained[own].astype(np.uint32)), pack(low[own].astype(np.uint32)),
        ))
    return pd.DataFrame(out, columns=[c.split()[0] for c in REQUEST.split(", ")])


def answers(rows: pd.DataFrame, k: int, factors: list[np.ndarray]) -> pd.DataFrame:
    """Corpus counts and context sums for all requests to one bucket; columns of `ANSWER`."""
    rows = rows.sort_values("slice")
    heads = [unpack(x, np.uint64) for x in rows["heads"]]
    sizes = [unpack(x, np.uint32) for x in rows["sizes"]]
    words = [unpack(n, np.uint64)[unpack(w, np.uint32)] for n, w in zip(rows["names"], rows["words"], strict=True)]
    all_of = lambda c, t: np.concatenate([unpack(x, t) for x in rows[c]])
    contexts, head = np.unique(np.concatenate(heads), return_inverse=True)
    sized = np.concatenate(sizes).astype(np.int64)
    context, divisor = np.repeat(head, sized), np.repeat(all_of("divisors", np.float64), sized)
    keys = mix64(contexts[context] * STEP + np.concatenate(words))
    _, place, gram = np.unique(keys, return_index=True, return_inverse=True)
    total = np.bincount(gram, all_of("trained", np.uint32), len(place)).astype(np.int64)
    seen = total > 0
    owner = context[place][seen]
    n = len(contexts)
    totals = np.bincount(owner, total[seen], n).astype(np.uint64)
    below = np.zeros(n)
    if k:
        low = discounted(all_of("low", np.uint32)[place][seen].astype(np.int64), factors[k - 1])
        below = np.bincount(owner, low / divisor[place][seen], n)
    few = np.stack([np.bincount(owner[total[seen] == r], minlength=n) for r in range(1, FLAT + 1)], 1).astype(np.uint32)
    known = [int((total == r).sum()) for r in range(1, FLAT + 2)]
    out, at, top = [], 0, 0
    for i, (slice_id, bucket) in enumerate(zip(rows["slice"], rows["bucket"], strict=True)):
        here, head_here = gram[at : at + len(words[i])], head[top : top + len(heads[i])]
        at, top = at + len(words[i]), top + len(heads[i])
        stats = (known, int(total.sum()), int(seen.sum())) if i == 0 else (None, None, None)
        out.append((
            slice_id, k, bucket, pack(total[here].astype(np.uint32)), pack(totals[head_here]), pack(below[head_here]),
            pack(few[head_here]), *stats,
        ))
    return pd.DataFrame(out, columns=[c.split()[0] for c in ANSWER.split(", ")])


@dataclass
class Model:
    """Slices, the answers of each order, and the numbers that hold for the whole corpus."""

    slices: DataFrame
    answers: list[DataFrame]
    factors: list[np.ndarray]
    tokens: int
    texts: int
    buckets: int
    train_tokens: int = 0
    vocabulary: int = 0

    def opened(self, row: pd.Series, answered: pd.DataFrame, order: int) -> Slice:
        """A slice with the answers it has so far."""
        part = Slice(row, order)
        for k in range(len(self.factors)):
            part.answered(k, answered, self.tokens, self.texts, self.buckets)
        return part

    def told(self) -> DataFrame:
        out = self.answers[0]
        for more in self.answers[1:]:
            out = out.unionByName(more)
        return out.select("slice", "level", "bucket", "counts", "totals", "below", "few")

    def plain(self) -> Model:
        """Without its tables, as the tasks need it."""
        return Model(None, [], self.factors, self.tokens, self.texts, self.buckets, self.train_tokens, self.vocabulary)


def exchanged(model: Model, k: int) -> DataFrame:
    """Rows of `ANSWER` for the n-grams of order k + 1, given the answers of the orders below."""
    plain = model.plain()

    def ask(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        part = plain.opened(left.iloc[0], right, k + 1)
        return requests(part, k, key[0], plain.factors, plain.tokens, plain.texts, plain.buckets)

    def ask_first(key: tuple, left: pd.DataFrame) -> pd.DataFrame:
        return ask(key, left, left)

    def reply(rows: pd.DataFrame) -> pd.DataFrame:
        return answers(rows, k, plain.factors)

    by_slice = model.slices.groupBy("slice")
    if k:
        asked = by_slice.cogroup(model.told().groupBy("slice")).applyInPandas(ask, REQUEST)
    else:
        asked = by_slice.applyInPandas(ask_first, REQUEST)
    return asked.groupBy("bucket").applyInPandas(reply, ANSWER)


def train(docs: DataFrame, ws: Workspace, trained: Column, order: int = ORDER, slice_tokens: int = SLICE_TOKENS, bucket_tokens: int = BUCKET_TOKENS) -> Model:
    """The model of the rows of `docs (doc_id, text)` in which `trained` holds, ready to score all of them."""
    slices = kept_by_slice(ws, sliced(docs, trained, slice_tokens))
    size = slices.agg(F.sum("n_tokens"), F.sum("n_docs")).first()
    tokens, texts = size[0] or 0, size[1] or 0
    model = Model(slices, [], [], tokens, texts, max(1, -(-tokens // bucket_tokens)))
    for k in range(order):
        found = ws.keep(exchanged(model, k), f"order-{k + 1}")
        sums = [F.sum(F.get("n_counts", F.lit(r))) for r in range(FLAT + 1)]
        row = found.agg(F.sum("total"), F.sum("distinct"), *sums).first()
        model.answers.append(found)
        model.factors.append(discounts([x or 0 for x in row[2:]]))
        if k == 0:
            model.train_tokens, model.vocabulary = row[0] or 0, row[1] or 0
    return model


def scored(model: Model, id_type: str) -> DataFrame:
    """`doc_id, n_tokens, n_known, train_tokens, base_score, score` of every row the model was given."""
    plain, order = model.plain(), len(model.factors)

    def work(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        part = plain.opened(left.iloc[0], right, order)
        unigrams = part.levels[0].count
        base = np.log10((unigrams + 0.1) / (plain.train_tokens + 0.1 * (plain.vocabulary + 1)))
        by_text = lambda values: np.add.reduceat(values, part.first)
        gram = log_probabilities(part.levels, plain.factors)
        return pd.DataFrame({
            "doc_id": pd.Series(part.ids, dtype=object), "train": list(left["train"].iloc[0]), "n_tokens": part.sizes,
            "n_known": by_text((unigrams > 0).astype(np.int64)[part.codes]), "train_tokens": plain.train_tokens,
            "base_score": by_text(base[part.codes]), "score": by_text(gram[part.levels[-1].ids]),
        })

    schema = f"doc_id {id_type}, train boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return model.slices.groupBy("slice").cogroup(model.told().groupBy("slice")).applyInPandas(work, schema)


def query(docs: DataFrame) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    model = train(docs, Workspace(docs.sparkSession), ~held_out)
    rows = scored(model, docs.schema["doc_id"].dataType.simpleString())
    return rows.withColumn("train", ~F.col("train")).withColumnRenamed("train", "held_out")
