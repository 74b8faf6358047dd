"""Substring dedup: content-defined chunks from a gear rolling hash, deduplicated by digest.

A text's bytes are cut where the low bits of the rolling hash vanish, so cuts depend on the bytes
just before them and an insertion moves no later cut. Chunks whose digest occurs in several documents
are joined to passages: neighbouring chunks belong together if another document has both side by
side. A passage whose chunks have twice `MIN_WORDS` words counts. A shorter one that could exceed
`MIN_WORDS` with the chunks around it is looked at in the texts: it counts if more than that many
words around one of its pairs of chunks are, word for word, in another document. For that all texts
with such a pair give the hashes of the windows of words around it.

Offsets are code points, ends exclusive; they are those of the passage's whole chunks. Null texts
are empty texts. Documents are told apart by doc_id, so repeated rows are one document; every row
without an id is a document of its own. Different texts of one doc_id are chunked and cut each for itself. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstack.llm.common import mapped, mix64
from quillstack.sources.workspace import Workspace

#: Bytes: a chunk is at least MIN_CHUNK and at most MAX_CHUNK long, and on average about MIN_CHUNK + 2**CUT_BITS.
MIN_CHUNK, MAX_CHUNK, CUT_BITS = 8, 128, 5
MIN_WORDS = 50
CORE_WORDS = 32
#: Chunks on each side of a passage's whole chunks that it may reach into.
REACH = 3
#: Odd, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15

#: A pseudo-random 64-bit value per byte value.
GEAR = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Rolling hash after every byte, h = 2h + gear[byte], over the last 32 bytes, by doubling."""
    h = GEAR[data].astype(np.uint32)
    width = 1
    while width < 32:
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    return h


def cut_points(data: np.ndarray) -> list[int]:
    """Ends of the chunks of some bytes.

    The vanishing bits are those 27 to 31, which 32 bytes decide.
    """
    n = len(data)
    marks = np.flatnonzero((gear_hashes(data) >> np.uint32(32 - CUT_BITS)) == 0) + 1
    cuts, last = [], 0
    for mark in marks.tolist():
        while mark - last > MAX_CHUNK:
            last += MAX_CHUNK
            cuts.append(last)
        if mark - last >= MIN_CHUNK:
            last = mark
            cuts.append(last)
    while n - last > MAX_CHUNK:
        last += MAX_CHUNK
        cuts.append(last)
    if n > last:
        cuts.append(n)
    return cuts


def chunked(texts: list[str]) -> dict:
    """Columns of the chunks of all texts: text number and hash, place, start, stop, words, before, after, digest.

    `words` counts the words that start in the chunk, `before` and `after` those of the `REACH` chunks on
    each side. The text's hash is Spark's xxhash64.
    """
    owner, whole, place, start, stop, words, before, after, digest = [], [], [], [], [], [], [], [], []
    for k, text in enumerate(texts):
        raw = text.encode("utf-8", "replace")
        data = np.frombuffer(raw, np.uint8)
        if not len(data):
            continue
        ends = np.array(cut_points(data))
        begins = np.r_[0, ends[:-1]]
        chars = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
        space = (data == 32) | ((data >= 9) & (data <= 13))
        word = np.r_[0, np.cumsum(~space & np.r_[True, space[:-1]])]
        count = word[ends] - word[begins]
        owner.append(np.full(len(ends), k))
        whole.append(np.full(len(ends), xxhash.xxh64_intdigest(raw, seed=42), np.uint64))
        place.append(np.arange(len(ends)))
        start.append(chars[begins])
        stop.append(chars[ends])
        words.append(count)
        total, at = np.r_[0, np.cumsum(count)], np.arange(len(ends))
        before.append(total[at] - total[np.maximum(at - REACH, 0)])
        after.append(total[np.minimum(at + 1 + REACH, len(ends))] - total[at + 1])
        digest.append(np.array([xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)], np.uint64))
    join = lambda x, t: np.concatenate(x).astype(t) if x else np.empty(0, t)
    return {
        "owner": join(owner, np.int64), "text_hash": join(whole, np.uint64).view(np.int64), "place": join(place, np.int32), "start": join(start, np.int32),
        "stop": join(stop, np.int32), "words": join(words, np.int16), "before": join(before, np.int16),
        "after": join(after, np.int16), "digest": join(digest, np.uint64).view(np.int64),
    }


def chunk_table(docs: DataFrame) -> DataFrame:
    """`doc, text_hash, place, start, stop, words, before, after, digest` of all chunks of `docs (doc_id, text)`."""

    def work(ids: list, texts: list) -> dict:
        out = chunked(texts)
        named = np.array(ids, dtype=np.int64) if len(ids) else np.empty(0, np.int64)
        return out | {"doc": named[out["owner"]]}

    schema = (
        "doc bigint, text_hash bigint, place int, start int, stop int, words smallint, before smallint, after smallint,"
        " digest bigint"
    )
    return mapped(_named(docs).select("_doc", "text"), work, schema)


#: Rows without an id get numbers from here on, which no id has.
NO_ID = -(2**63)
NO_ID_END = NO_ID + 2**56


def numbered(docs: DataFrame, ws: Workspace) -> DataFrame:
    """`docs` with `_doc`, written: what one job finds in rows without an id, another can look up by it."""
    return ws.keep(_named(docs), "numbered")


def _named(docs: DataFrame) -> DataFrame:
    """`docs` with `_doc`: ids as whole numbers; rows without one are numbered in the stored rows' order."""
    if "_doc" in docs.columns:
        return docs
    rows = docs.withColumn("_row", F.monotonically_increasing_id())
    return rows.withColumn("_doc", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID) + F.col("_row"))).drop("_row")


def shared(rows: DataFrame, key: str) -> DataFrame:
    """`key, first_doc` of the keys that several documents have; combined before the shuffle."""
    ends = rows.groupBy(key).agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))
    return ends.where("first_doc < last_doc").drop("last_doc")


def word_windows(text: str, cuts: list[int], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and stop of the windows of `size` words around the chunks that meet at `cuts`.

    `cuts` are triples (start, cut, stop) of two neighbouring chunks, in code points. A window is given if it
    has all words of such a pair; of a pair with more words, those inside it.
    """
    raw = text.encode("utf-8", "replace")
    data = np.frombuffer(raw, np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    chars = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    edge = np.diff(np.r_[1, space, 1].astype(np.int8))
    begin, end = chars[np.flatnonzero(edge == -1)], chars[np.flatnonzero(edge == 1)]
    n = len(begin) - size + 1
    if n < 1:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    pairs = np.array(cuts, np.int64).reshape(-1, 3)
    first = np.searchsorted(end, pairs[:, 0], "right")
    short = np.searchsorted(begin, pairs[:, 2], "left") - size  # the first window that ends with the pair's last word
    lo, hi = np.clip(np.minimum(first, short), 0, n), np.clip(np.maximum(first, short) + 1, 0, n)
    wanted = np.zeros(n + 1, np.int64)
    np.add.at(wanted, lo, 1)
    np.add.at(wanted, np.maximum(hi, lo), -1)
    at = np.flatnonzero(np.cumsum(wanted[:-1]) > 0)
    words = pd.util.hash_array(np.array(raw.split(), dtype=object))
    powers = np.cumprod(np.r_[np.uint64(1), np.full(len(words) - 1, BASE, np.uint64)])
    inverse = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, pow(BASE, -1, 2**64), np.uint64)])
    total = np.r_[np.uint64(0), np.cumsum(words * powers)]
    return mix64((total[at + size] - total[at]) * inverse[at]), begin[at], end[at + size - 1]


def windows(docs: DataFrame, places: DataFrame, size: int) -> DataFrame:
    """`text_hash, lo, hi, win, start, stop`: windows around the `places (text_hash, lo, hi, cuts)`, once per text."""

    def work(ids: list, texts: list) -> dict:
        found = [word_windows(t, [tuple(c.values()) for c in i["cuts"]], size) for i, t in zip(ids, texts, strict=True)]
        times = [len(f[0]) for f in found]
        each = lambda name: np.repeat(np.array([i[name] for i in ids], np.int64), times)
        column = lambda k, t: np.concatenate([f[k] for f in found]).astype(t) if found else np.empty(0, t)
        return {
            "text_hash": each("text_hash"), "lo": each("lo"), "hi": each("hi"), "win": column(0, np.uint64).view(np.int64),
            "start": column(1, np.int32), "stop": column(2, np.int32),
        }

    texts = docs.where("text is not null").groupBy(F.xxhash64("text").alias("text_hash")).agg(F.first("text").alias("text"))
    rows = texts.join(places, "text_hash").select(F.struct("text_hash", "lo", "hi", "cuts").alias("id"), "text")
    return mapped(rows, work, "text_hash bigint, lo bigint, hi bigint, win bigint, start int, stop int")


def confirmed(docs: DataFrame, ws: Workspace, paired: DataFrame, unsure: DataFrame, min_words: int) -> DataFrame:
    """Those of the `unsure` pieces whose passage has more than `min_words` words in another document.

    `seen_in` is the first document that has such words.
    """
    asked = unsure.select(F.explode("joints.pair").alias("pair")).distinct()
    places = paired.join(asked, "pair").groupBy("text_hash").agg(
        F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.collect_set(F.struct("start", "stop", "pair_stop")).alias("cuts")
    )
    found = ws.keep(windows(docs, places, min_words + 1), "windows")
    common = found.groupBy("win").agg(F.min("lo").alias("seen_in"), F.max("hi").alias("last")).where("seen_in < last")
    hits = found.join(common.drop("last"), "win").groupBy("text_hash").agg(
        F.collect_set(F.struct("start", "stop", "seen_in")).alias("hits")
    )
    inside = lambda h: F.exists("joints", lambda j: (h["start"] < j["cut"]) & (j["cut"] < h["stop"]))
    seen_in = F.array_min(F.transform(F.filter("hits", inside), lambda h: h["seen_in"]))
    return unsure.join(hits, "text_hash").withColumn("seen_in", seen_in).where("seen_in is not null").drop("hits")


def passages(
    docs: DataFrame, ws: Workspace, min_words: int = MIN_WORDS, core_words: int = CORE_WORDS
) -> DataFrame:
    """`doc_id, start, stop, n_words, n_chunks, first_doc_id, is_first, doc, text_hash` of all shared passages.

    A passage is given in pieces, one row each, so that every piece has one first document: the first
    that has its chunks side by side. `is_first` tells that no earlier document has the piece, or only
    a stretch of fewer than `core_words` words. `doc` and `text_hash` name the text the offsets belong to.
    """
    chunks = ws.keep(chunk_table(docs), "chunks")
    # A chunk's length and counts fit a byte each; narrow rows are half of the shuffle.
    bits = {"chars": 24, "words": 16, "before": 8, "after": 0}
    extent = F.shiftleft(F.col("start").cast("bigint"), 32)
    for name, at in bits.items():
        value = F.col("stop") - F.col("start") if name == "chars" else F.col(name)
        extent = extent + F.shiftleft(value.cast("bigint"), at)
    narrow = chunks.select("doc", "text_hash", "place", "digest", extent.alias("extent"))
    seen = narrow.join(shared(chunks, "digest"), "digest").repartition("doc", "text_hash")
    # The repeated rows of a document are the same chunks.
    seen = seen.dropDuplicates(["doc", "text_hash", "place"])
    byte = {n: F.shiftright("extent", at).bitwiseAND(F.lit(255)).cast("int") for n, at in bits.items()}
    start = F.shiftright("extent", 32).cast("int")
    seen = seen.withColumns(byte | {"start": start, "stop": start + byte["chars"]}).drop("extent", "chars")
    along = Window.partitionBy("doc", "text_hash").orderBy("place")
    is_next = F.lead("place").over(along) == F.col("place") + 1
    pair = F.when(is_next, F.xxhash64("digest", F.lead("digest").over(along)))
    paired = ws.keep(seen.withColumn("pair", pair).withColumn("pair_stop", F.lead("stop").over(along)), "pairs")
    both = shared(paired.where("pair is not null").select("pair", "doc"), "pair").withColumnRenamed("first_doc", "goes_on")
    linked = paired.where("pair is not null").join(both, "pair", "left").unionByName(
        paired.where("pair is null").withColumn("goes_on", F.lit(None).cast("bigint"))
    )
    # A passage starts at each chunk that the one before does not go on to.
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    count = lambda when: F.sum(F.when(when, 1).otherwise(0)).over(so_far)
    came_from = F.lag("goes_on").over(along)
    runs = linked.withColumn("starts", came_from.isNull())
    # A chunk belongs to the first document that has it beside a neighbour.
    runs = runs.withColumn("first", F.coalesce(F.least(came_from, "goes_on"), "first_doc"))
    runs = runs.withColumn("earlier", F.col("first") < F.col("doc")).withColumn("run", count(F.col("starts")))
    turns = F.col("starts") | (F.col("earlier") != F.lag("earlier").over(along))
    runs = runs.withColumn("stretch", count(turns))
    short = F.sum("words").over(Window.partitionBy("doc", "text_hash", "stretch")) < core_words
    runs = runs.withColumn("first", F.when(short, F.col("doc")).otherwise(F.col("first")))
    breaks = F.col("starts") | (F.col("first") != F.lag("first").over(along))
    pieces = runs.withColumn("piece", count(breaks)).groupBy("doc", "text_hash", "run", "piece").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("words").alias("n_words"),
        F.count(F.lit(1)).alias("n_chunks"), F.min("first").alias("first_doc"),
        F.min_by("before", "place").alias("before"), F.max_by("after", "place").alias("after"),
        F.collect_list(F.when(F.col("goes_on").isNotNull(), F.struct("pair", F.col("stop").alias("cut")))).alias("joints"),
    )
    whole = Window.partitionBy("doc", "text_hash", "run")
    words = F.sum("n_words").over(whole)
    reach = words + F.min_by("before", "piece").over(whole) + F.max_by("after", "piece").over(whole)
    pieces = pieces.withColumn("words", words).withColumn("reach", reach).withColumn("sure", F.col("words") >= 2 * min_words)
    joints = F.when(~F.col("sure"), F.flatten(F.collect_list("joints").over(whole)))
    pieces = ws.keep(pieces.where("sure or reach > %d" % min_words).withColumn("joints", joints), "pieces")
    unsure = confirmed(docs, ws, paired, pieces.where("not sure and size(joints) > 0"), min_words)
    # All stretches of a passage of few whole words are short; the words around them tell the first document.
    first_seen = F.when(F.col("words") < core_words, F.least("seen_in", "doc")).otherwise(F.col("first_doc"))
    long = pieces.where("sure").unionByName(
        unsure.withColumn("first_doc", first_seen).drop("seen_in")
    )
    named = lambda c: F.when(~F.col(c).between(NO_ID, NO_ID_END), F.col(c))
    return long.select(
        named("doc").alias("doc_id"), "start", "stop", "n_words", "n_chunks", named("first_doc").alias("first_doc_id"),
        (F.col("doc") == F.col("first_doc")).alias("is_first"), "doc", "text_hash",
    )


def without_repeats(docs: DataFrame, found: DataFrame) -> DataFrame:
    """`docs` whose texts lose the passages that an earlier document has; columns and rows stay.

    `found` are the passages of these very `docs`. If rows may lack an id, both must come from one
    `numbered` table, as numbers given anew follow the file splits of the job.
    """
    cuts = found.where("not is_first").groupBy(F.col("doc").alias("_doc"), F.col("text_hash").alias("_hash")).agg(
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("_cuts")
    )
    rows = _named(docs).withColumn("_hash", F.xxhash64("text"))
    rows = rows.join(cuts, ["_doc", "_hash"], "left").drop("_doc", "_hash")  # `_doc` of `numbered` goes too
    open_at = lambda i: F.coalesce(F.get("_cuts", i - 1)["stop"], F.lit(0))
    piece = lambda c, i: F.substring("text", open_at(i) + 1, c["start"] - open_at(i))
    tail = F.expr("substring(text, element_at(_cuts, -1).stop + 1)")
    text = F.concat(F.array_join(F.transform("_cuts", piece), ""), tail)
    return rows.withColumn("text", F.when(F.col("_cuts").isNull(), F.col("text")).otherwise(text)).drop("_cuts")


def deduplicated(docs: DataFrame, ws: Workspace) -> DataFrame:
    """`docs` without the passages that an earlier document has."""
    rows = numbered(docs, ws)
    return without_repeats(rows, ws.keep(passages(rows, ws), "passages"))


def query(docs: DataFrame) -> DataFrame:
    return passages(docs, Workspace(docs.sparkSession))
