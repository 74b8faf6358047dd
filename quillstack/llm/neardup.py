"""Near duplicates: ProbMinHash signatures of weighted word shingles, bands, and verified links.

The shingles of a text are its runs of five words, weighted by 1 + log of their count. Every shingle
is a Poisson process of its weight's rate whose points fall into `SIZE` registers; a register keeps
the shingle that came first, and a shingle stops once its next point is later than all registers of
its text. Two texts agree in a register with the probability Jaccard similarity of their shingles.
A link is a plain Jaccard similarity, which differs from that one where shingles repeat, so a text
with repeated shingles also has the signature of its shingles at weight 1. Texts without repeats
have the same signature both ways, and all signatures share one set of bands.

Equal texts are one node. Nodes that agree in all registers of a band share a bucket; each bucket
compares its members with few of them, never all pairs. Candidates are verified on their whole
shingle sets. Buckets of four and more members that then still hold several classes are worked off in
rounds: some members are compared with all others of the bucket and leave it, until every two members
of a bucket are in one class or were compared. So no link between texts that share a bucket is lost.

A text of one to four words is one shingle; texts without words are near only to equal texts. Null
texts are empty texts. A class is named by its smallest doc_id (null if it has none); repeated rows
are members of one class. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstack.llm.common import body, mapped_batches, mix64
from quillstack.llm.components import components
from quillstack.sources.workspace import Workspace

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 28, 5
SIZE = BANDS * ROWS
#: Members of a bucket that are compared in one round: 64, 512, then at most this many.
SLOTS = 4096

STEP = np.uint64(0x9E3779B97F4A7C15)
#: About as many points of shingles are drawn at a time at least.
POINTS = 4096
#: Which bytes stand between words.
IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts one after another, and every text's number of words.

    The words are cut out of the column's bytes as a whole; only distinct ones become Python values.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    _, ends, letters = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    letters = np.frombuffer(letters, np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.empty(0, np.uint8)
    cuts = ends - ends[0]
    inside = ~IS_SPACE[letters]
    edges = np.zeros(len(letters) + 1, bool)  # the beginning of a text
    edges[cuts] = True
    starts = inside & (edges[:-1] | np.r_[True, ~inside[:-1]])
    stops = inside & (edges[1:] | np.r_[~inside[1:], True])
    first = np.flatnonzero(starts)
    sizes = np.diff(np.searchsorted(first, cuts))
    offsets = np.r_[0, np.cumsum(np.flatnonzero(stops) + 1 - first)]
    whole = [None, pa.py_buffer(offsets), pa.py_buffer(letters[inside])]
    coded = pa.Array.from_buffers(pa.large_binary(), len(first), whole).dictionary_encode()
    hashed = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False), categorize=False)
    return hashed[coded.indices.to_numpy()], sizes


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text number, shingle hash, weight) of all texts, by text, then hash, and the texts' numbers of words."""
    hashed, sizes = words(texts)
    if not len(hashed):
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0), sizes
    ends = np.cumsum(sizes)
    whole = max(len(hashed) - SHINGLE + 1, 0)
    runs = np.zeros(whole, np.uint64)
    for k in range(SHINGLE):
        runs = mix64(runs * STEP + hashed[k : k + whole])
    parts = []
    for end, size in zip(ends.tolist(), sizes.tolist(), strict=True):
        if size >= SHINGLE:
            parts.append(runs[end - size : end - SHINGLE + 1])
            parts[-1].sort()  # places of one text; `runs` of others are not touched
        elif size:
            short = np.zeros(1, np.uint64)
            for k in range(end - size, end):
                short = mix64(short * STEP + hashed[k : k + 1])
            parts.append(short)
    runs = np.concatenate(parts)
    owner = np.repeat(np.flatnonzero(sizes), [len(part) for part in parts])
    first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (runs[1:] != runs[:-1])])
    return owner[first], runs[first], 1 + np.log(np.diff(np.r_[first, len(runs)])), sizes


def signatures(n: int, owner: np.ndarray, runs: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """ProbMinHash of `n` texts: the first shingle to arrive in every register, as (n, SIZE).

    `owner` ascends. When few shingles are left, several of their points are drawn at a time; a point
    later than all registers of its text changes none.
    """
    first = np.full(n * SIZE, np.inf)
    value = np.zeros(n * SIZE, np.uint64)
    last = np.full(n, np.inf)
    time, turn = np.zeros(len(runs)), 0
    while len(runs):
        turns = np.arange(turn + 1, turn + 1 + min(max(POINTS // len(runs), 1), 64), dtype=np.uint64)
        turn += len(turns)
        draw = mix64(runs + (turns * STEP)[:, None])
        gaps = np.log(((draw >> np.uint64(11)) + np.uint64(1)) * 2.0**-53) / weight
        gaps[0] = time - gaps[0]
        times = np.subtract.accumulate(gaps, axis=0)
        time = times[-1]
        row, column = np.nonzero(times < last[owner])
        when, text = times[row, column], owner[column]
        register = text * SIZE + (mix64(draw[row, column]) % np.uint64(SIZE)).view(np.int64)
        np.minimum.at(first, register, when)
        won = np.flatnonzero(first[register] == when)
        value[register[won]] = runs[column[won]]
        texts = owner[np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])]
        last[texts] = first.reshape(n, SIZE)[texts].max(axis=1)
        live = np.flatnonzero(time < last[owner])
        owner, runs, weight, time = owner[live], runs[live], weight[live], time[live]
    return value.reshape(n, SIZE)


def band_keys(value: np.ndarray) -> np.ndarray:
    """One key per text and band, which also tells the bands apart."""
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(value), BANDS)).copy()
    parts = value.reshape(len(value), BANDS, ROWS)
    for r in range(ROWS):
        keys = mix64(keys * STEP + parts[:, :, r])
    return keys.view(np.int64)


def signed(texts: DataFrame) -> DataFrame:
    """`texts` with `n_words` and band `keys` of every row instead of `text`; no keys for texts without words."""

    def work(part: pa.RecordBatch) -> dict:
        owner, runs, weight, sizes = shingles(part["text"])
        n = len(sizes)
        bands = band_keys(signatures(n, owner, runs, weight))
        keys, kept = np.zeros((n, 2 * BANDS), np.int64), np.zeros((n, 2 * BANDS), bool)
        keys[:, :BANDS], kept[:, :BANDS] = bands, (sizes > 0)[:, None]
        repeats = np.zeros(n, bool)
        repeats[owner[weight > 1]] = True
        again = np.flatnonzero(repeats)
        held = repeats[owner]
        place = np.searchsorted(again, owner[held])
        plain = band_keys(signatures(len(again), place, runs[held], np.ones(len(place))))
        keys[again, BANDS:], kept[again, BANDS:] = plain, plain != bands[again]
        return {"n_words": pa.array(sizes), "keys": listed(kept.sum(axis=1), keys[kept])}

    return mapped_batches(texts, work, "n_words bigint, keys array<bigint>")


def listed(sizes: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.r_[0, np.cumsum(sizes)].astype(np.int32), values)


def shingled(texts: DataFrame) -> DataFrame:
    """`texts` with the shingles `runs` of every row instead of `text`."""

    def work(part: pa.RecordBatch) -> dict:
        owner, runs, _, sizes = shingles(part["text"])
        return {"runs": listed(np.bincount(owner, minlength=len(sizes)), runs.view(np.int64))}

    return mapped_batches(texts, work, "runs array<bigint>")


def verified(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """`a, b, similarity` of those `pairs (a, b)` whose whole shingle sets have that Jaccard similarity."""
    # Only the sets the pairs name are shuffled.
    named = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    sets = sets.join(named, "node", "left_semi")
    side = lambda n: sets.select(F.col("node").alias(n), F.col("runs").alias(f"runs_{n}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    n_a, n_b, both = F.size("runs_a"), F.size("runs_b"), F.size(F.array_intersect("runs_a", "runs_b"))
    # The same bound as on the similarity below, in a form that intersects the sets once and only those of like size.
    like = F.least(n_a, n_b) >= similar * F.greatest(n_a, n_b) - 1e-6
    joined = joined.where(like & (both * (1 + similar) >= similar * (n_a + n_b) - 1e-6))
    return joined.select("a", "b", (both / F.greatest(n_a + n_b - both, F.lit(1))).alias("similarity"))


def ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def links(ws: Workspace, members: DataFrame, sets: DataFrame, similar: float, slots: int = SLOTS):
    """Verified links and `node, comp` over the buckets' `members (key, node)`."""
    ends = members.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    star = members.join(ends, "key")
    pairs = star.select(*ordered(F.col("node"), F.col("lo"))).union(star.select(*ordered(F.col("node"), F.col("hi"))))
    tested = ws.keep(pairs.where("a < b").distinct(), "pairs")
    found = ws.keep(verified(tested, sets, similar), "found")
    comps = components(ws, found)
    # Of at most three members every two have been compared as a pair with the smallest or the largest.
    left = mixed(members, comps, least=4).select("node").distinct()
    live = ws.keep(rare_first(sets.join(left, "node", "left_semi"), similar), "rare")
    turn = 0
    while True:
        turn += 1
        placed = mixed(live, comps)
        useful = placed.where("indexed").select("key").distinct()
        placed = ws.keep(placed.join(useful, "key", "left_semi"), "mixed")
        if placed.isEmpty():
            return found, comps
        slot = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(min(slots, 8 ** (turn + 1))))
        chosen = placed.where("indexed").groupBy("key", slot.alias("slot")).agg(
            F.min(F.struct("node", "comp", "n", "behind")).alias("r")
        )
        chosen = ws.keep(chosen.select("key", F.col("r").alias("rep")), "reps")
        # The compared text is the smaller one. A similar pair also meets under the first shingle both have,
        # and from there on both have as many shingles as they must share.
        enough = F.least("behind", "rep.behind") * (1 + similar) >= similar * (F.col("n") + F.col("rep.n")) - 1e-6
        after = F.struct(F.col("n"), F.col("node")) > F.struct(F.col("rep.n"), F.col("rep.node"))
        met = placed.join(chosen, "key").where((F.col("comp") != F.col("rep.comp")) & after & enough)
        fresh = met.select(*ordered(F.col("node"), F.col("rep.node"))).distinct()
        fresh = ws.keep(fresh.join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = tested.union(fresh)
        more = ws.keep(verified(fresh, sets, similar), "found")
        found = found.union(more)
        if not more.isEmpty():
            comps = components(ws, found)
        done = chosen.select("key", F.col("rep.node").alias("node"), F.lit(False).alias("waits"))
        live = placed.drop("comp").join(done, ["key", "node"], "left")
        live = live.withColumn("indexed", F.col("indexed") & F.coalesce("waits", F.lit(True))).drop("waits")


def mixed(members: DataFrame, comps: DataFrame, least: int = 2) -> DataFrame:
    """`members` with `comp`, of the buckets of at least that many members, who are in several classes."""
    placed = members.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    ends = placed.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("n"))
    several = ends.where((F.col("x") < F.col("y")) & (F.col("n") >= least))
    return placed.join(several.select("key"), "key", "left_semi")


def rare_first(sets: DataFrame, similar: float) -> DataFrame:
    """Finer buckets `key, node, n, behind, indexed`: each text under its rarest shingles.

    Order all shingles by how many of the given texts have them. Two texts cannot be similar if the
    shingles that make up the first 1 - `similar` of each, in this order, are all different: one of
    them then lacks that share of its shingles in the other. For the smaller text of a pair even the
    first 1 - 2 `similar` / (1 + `similar`) must meet them; these are `indexed`. Shingles that only one
    text has come first and meet nothing, so a text with many of its own has no bucket at all.
    `n` counts a text's shingles, `behind` those from `key` on.
    """
    tokens = sets.select("node", F.size("runs").alias("n"), F.explode("runs").alias("key"))
    several = tokens.groupBy("key").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    shared = tokens.join(several, "key")
    behind = Window.partitionBy("node").orderBy(F.desc("texts"), F.desc("key")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = shared.withColumn("behind", F.count(F.lit(1)).over(behind))
    before = F.col("n") - F.col("behind")
    first = lambda share: before <= (1 - share + 1e-9) * F.col("n")
    indexed = first(2 * similar / (1 + similar))
    return ranked.where(first(similar)).select("key", "node", "n", "behind", indexed.alias("indexed"))


def classes(docs: DataFrame, ws: Workspace, similar: float = SIMILAR, row: Column | None = None) -> DataFrame:
    """`digest, n_words, first, class_id, class_size, n_links` per distinct text of `docs (doc_id, text)`.

    `first` is the smallest (doc_id, row) of the class, rows without an id last; `class_size` counts
    rows; `n_words` are the text's words; `n_links` counts the text's verified links that joined or tested its class: texts that are
    already of one class are not compared again, so it is a lower bound that depends on the numbering.
    `row` are the rows' numbers; callers that join on them pass numbers that are written down.
    """
    texts = docs.select(F.md5(body()).alias("digest"), body().alias("text"))
    number = F.monotonically_increasing_id() if row is None else row
    rows = docs.select(F.md5(body()).alias("digest"), "doc_id", number.alias("row"), body().alias("text"))
    nodes = signed(rows).groupBy("digest").agg(
        F.first("keys").alias("keys"), F.first("n_words").alias("n_words"),
        F.min(order_of(F.col("doc_id"), F.col("row"))).alias("first"), F.count(F.lit(1)).alias("copies"),
    ).withColumn("node", F.monotonically_increasing_id())
    nodes = ws.keep(nodes, "nodes")
    buckets = nodes.select("node", F.explode("keys").alias("key"))
    shared = buckets.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    members = ws.keep(buckets.join(shared.select("key"), "key", "left_semi"), "members")
    wanted = nodes.select("node", "digest").join(members.select("node").distinct(), "node", "left_semi")
    bodies = texts.join(wanted, "digest").groupBy("node").agg(F.first("text").alias("text"))
    sets = ws.keep(shingled(bodies), "shingles")
    found, comps = links(ws, members, sets, similar)
    ends = found.select(F.col("a").alias("node")).union(found.select(F.col("b").alias("node")))
    degree = ends.groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    of_node = nodes.select("node", "digest", "n_words", "first", "copies").join(comps, "node", "left").join(degree, "node", "left")
    of_node = of_node.select(
        "digest", "n_words", "first", "copies", F.coalesce("comp", "node").alias("comp"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    whole = of_node.groupBy("comp").agg(F.min("first").alias("first"), F.sum("copies").alias("class_size"))
    return of_node.drop("first", "copies").join(whole, "comp").select(
        "digest", "n_words", "first", F.col("first.doc_id").alias("class_id"), "class_size", "n_links"
    )


def order_of(doc_id: Column, row: Column) -> Column:
    return F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("doc_id"), row.alias("row"))


#: Name of the row numbers that `keep_first` writes beside the columns of its table.
ROW = "_quillstack_row"


def keep_first(docs: DataFrame, ws: Workspace, similar: float = SIMILAR) -> DataFrame:
    """`docs` with one row of each class, its smallest; all columns stay.

    The rows are numbered once and written: numbers given anew in a later job follow that job's file
    splits, which change when executors come or go.
    """
    rows = ws.keep(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")
    found = classes(rows, ws, similar, F.col(ROW)).select(F.col("first.row").alias(ROW)).distinct()
    return rows.join(found, ROW, "left_semi").drop(ROW)


def query(docs: DataFrame) -> DataFrame:
    ws = Workspace(docs.sparkSession)
    found = ws.keep(classes(docs, ws), "classes")
    rows = docs.select("doc_id", F.md5(body()).alias("digest"))
    return rows.join(found.select("digest", "class_id", "class_size", "n_links"), "digest").drop("digest")

