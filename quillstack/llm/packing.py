"""Best-fit packing under conflicts: documents into bins of fixed capacity.

Documents are dealt to shards of about `SHARD_ROWS` rows by a hash of their row, and every shard is
packed by itself, largest pieces first. Open bins are ordered by residual capacity, and each carries
a bitmap of its sources and one of its duplicate clusters; the search starts at the tightest bin that
could hold the piece and goes on to its successors until one has neither the piece's source nor its
cluster. So no bin holds two documents of a source or two of a cluster. `query` takes the classes of
the near-duplicate operator as clusters; `pack` takes a column, and without one only equal texts.

Texts longer than a bin become full bins and a remainder; nothing is cut off or left out. Packing
shuffles only ids, lengths and hashes, never texts, and a hot source is spread over all shards.

A null text has no tokens and gets one empty piece; null sources are one source of their own (every
null conflicts with every other null). Repeated rows are packed each for itself; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstack.llm import neardup
from quillstack.llm.common import body, word_count
from quillstack.operators.skew import lookup
from quillstack.sources.workspace import Workspace

CAPACITY = 2048
SHARD_ROWS = 4096
SCHEMA = "shard bigint, bin bigint, slot int, doc_id {id}, source string, piece int, start bigint, n_tokens bigint"


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> tuple[list[int], int]:
    """Bin of every piece and the number of bins; pieces are placed in the order given.

    `sources` and `clusters` are small whole numbers, bits of the bins' bitmaps.
    """
    open_bins: list[tuple[int, int]] = []  # (residual, bin), ascending
    held_sources: list[int] = []
    held_clusters: list[int] = []
    placed = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        s, c = 1 << source, 1 << cluster
        at = bisect_left(open_bins, (size, -1))
        while at < len(open_bins) and (held_sources[open_bins[at][1]] & s or held_clusters[open_bins[at][1]] & c):
            at += 1
        if at < len(open_bins):
            residual, b = open_bins.pop(at)
        else:
            residual, b = capacity, len(held_sources)
            held_sources.append(0)
            held_clusters.append(0)
        held_sources[b] |= s
        held_clusters[b] |= c
        placed.append(b)
        if residual > size:
            insort(open_bins, (residual - size, b))
    return placed, len(held_sources)


def _codes(values: pd.Series) -> pd.Series:
    return pd.Series(pd.factorize(values, use_na_sentinel=False)[0], index=values.index)


def pack_shard(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Pieces of one shard's documents with their bins; columns of `SCHEMA`."""
    rows = rows.sort_values(["n_tokens", "doc_id", "digest"], ascending=[False, True, True], kind="stable")
    rows = rows.reset_index(drop=True)
    full = (rows["n_tokens"] // capacity).where(rows["n_tokens"] % capacity > 0, rows["n_tokens"] // capacity - 1)
    full = full.clip(lower=0).astype("int64")
    rest = rows["n_tokens"] - full * capacity
    order = rest.sort_values(ascending=False, kind="stable").index
    # Only clusters with several members need bits of their own; others share bit 0 of nobody's bitmap.
    many = rows["cluster"].duplicated(keep=False)
    cluster = _codes(rows["cluster"].where(many))
    lone = ~many
    source = _codes(rows["source"])
    bits = cluster.where(many, 0)
    placed, used = best_fit(
        rest[order].tolist(), source[order].tolist(), _masked(bits, lone)[order].tolist(), capacity
    )
    tail = pd.DataFrame({"row": order, "bin": placed, "piece": full[order].to_numpy(), "n_tokens": rest[order].to_numpy()})
    whole = rows.index.repeat(full)
    head = pd.DataFrame({"row": whole})
    head["piece"] = head.groupby("row").cumcount()
    head["bin"] = used + pd.RangeIndex(len(head))
    head["n_tokens"] = capacity
    out = pd.concat([tail, head], ignore_index=True)
    out["slot"] = out.groupby("bin").cumcount()
    out["start"] = out["piece"] * capacity
    facts = rows.loc[out["row"], ["shard", "doc_id", "source"]].reset_index(drop=True)
    return pd.concat([out.reset_index(drop=True), facts], axis=1)


def _masked(bits: pd.Series, lone: pd.Series) -> pd.Series:
    """Cluster bits; documents without copies get bits nobody else in the shard has."""
    fresh = lone.cumsum() + int(bits.max() if len(bits) else 0) + 1
    return bits.where(~lone, fresh).astype("int64")


def hashed(docs: DataFrame, *more: str | Column) -> DataFrame:
    """`doc_id, source, digest, md5, row` and the columns `more` of every row; texts end here."""
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    text = body()
    return docs.select(
        "doc_id", source.alias("source"), F.xxhash64(text).alias("digest"), F.md5(text).alias("md5"),
        F.monotonically_increasing_id().alias("row"), *more,
    )


def measured(docs: DataFrame, *more: str) -> DataFrame:
    """The columns of `hashed` and `n_tokens`."""
    return hashed(docs, word_count(body()).alias("n_tokens"), *more)


def pack(
    docs: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS, cluster: str | None = None
) -> DataFrame:
    """One row per piece: `shard, bin, slot, doc_id, source, piece, start, n_tokens`; start counts tokens.

    `cluster` names a column of `docs`; rows in which it is null conflict with equal texts only.
    """
    rows = measured(docs.withColumn("_cluster", F.col(cluster)) if cluster else docs, *(["_cluster"] if cluster else []))
    return pack_rows(rows, docs.count(), capacity, shard_rows)


def pack_rows(rows: DataFrame, n: int, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Pieces of the `n` rows of `measured`, which may have a column `_cluster`."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    own = F.xxhash64(F.lit("text"), "digest")
    if "_cluster" in rows.columns:
        own = F.when(F.col("_cluster").isNull(), own).otherwise(F.xxhash64(F.lit("cluster"), "_cluster"))
    shards = max(1, -(-n // shard_rows))
    rows = rows.select(
        "doc_id", "source", "n_tokens", "digest", own.alias("cluster"),
        F.pmod(F.xxhash64("doc_id", "row"), F.lit(shards)).alias("shard"),
    )
    # Rows are narrow but packing is work: as many tasks as a shuffle has, not as their bytes would fill.
    tasks = min(shards, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.repartition(tasks, "shard")
    order = [f.split()[0] for f in SCHEMA.split(", ")]

    def work(part: pd.DataFrame) -> pd.DataFrame:
        return pack_shard(part, capacity)[order]

    return rows.groupBy("shard").applyInPandas(work, SCHEMA.format(id=kind))


def query(docs: DataFrame) -> DataFrame:
    ws = Workspace(docs.sparkSession)
    found = ws.keep(neardup.classes(docs, ws), "classes")
    # The near-duplicate operator has cut every text into words, so its lengths are taken with its classes.
    texts = found.select(
        F.col("digest").alias("md5"), F.col("first.row").alias("_cluster"), F.col("n_words").alias("n_tokens")
    )
    rows = ws.keep(hashed(docs), "rows")
    return pack_rows(lookup(ws, rows, texts, "md5", staged=True), rows.count())
