"""Merkle manifest of a table: leaf digests, one tree per source, one tree over the sources, proofs.

A row's leaf hashes its fields, each as its length and value. In a source leaves ascend by doc_id;
every `ARITY` consecutive nodes become their digest until one is left, the source's subroot, and the
subroots become the root in the same way.

Texts are read once and end in their leaf. Leaves are numbered by a range-partitioned sort, so the
largest source is cut into superblocks of `ARITY ** BLOCK_LEVELS` leaves like any other. Going up, each
superblock is reduced to its top node, and the tops, a few thousandths of the leaves, are the leaves
of the next round. Going down, the nodes of a superblock are cogrouped with the outer nodes that its
proofs need: one task's call reduces the superblock again, joins the proofs of the inner levels with
the outer ones and folds them. No call holds more than one superblock and one outer path.

Null fields are the text `-`. Rows without a doc_id come first in their source, rows of one doc_id
are ordered by their leaf; equal rows have equal leaves and a place each. Rows without a doc_id are
not tampered with. Null sources are a source of their own, before all others. Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstack.operators.skew import global_rank, lookup
from quillstack.sources.workspace import Workspace

ARITY = 3
BLOCK_LEVELS = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Stands for the folded node in a proof's level.
SELF = "."


def leaf_digest(fields: dict[str, Column]) -> Column:
    """Lowercase hex digest of a row's fields in the order of `FIELDS`."""
    framed = [F.concat(F.octet_length(c).cast("string"), F.lit(":"), c) for c in fields.values()]
    return F.sha2(F.concat(*[F.coalesce(c, F.lit("-")) for c in framed]).cast("binary"), 256)


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """`doc_id, source, leaf, changed`: a leaf per row and, where `tampered` changes the text, that text's leaf."""
    fields = {c: F.col(c).cast("string") for c in FIELDS}
    text = F.lit(None).cast("string") if tampered is None else tampered
    changed = F.when(text.isNotNull() & (text != fields["text"]), leaf_digest(fields | {"text": text}))
    return docs.select("doc_id", fields["source"].alias("source"), leaf_digest(fields).alias("leaf"), changed.alias("changed"))


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def parents(nodes: list[str]) -> list[str]:
    return [digest("".join(nodes[i : i + ARITY])) for i in range(0, len(nodes), ARITY)]


def reduced(nodes: list[str], whole: bool) -> list[list[str]]:
    """The levels of a superblock from its nodes up; `whole` trees end at one node, parts after `BLOCK_LEVELS`."""
    levels = [nodes]
    while len(levels[-1]) > 1 if whole else len(levels) <= BLOCK_LEVELS:
        levels.append(parents(levels[-1]))
    return levels


def inner_proofs(levels: list[list[str]]) -> list[list[str]]:
    """Of every node of the lowest level, its runs up to the top with `SELF` in the node's place."""
    paths: list[list[str]] = [[]]
    for level in reversed(levels[:-1]):
        runs = [level[i : i + ARITY] for i in range(0, len(level), ARITY)]
        paths = [
            ["".join([*run[:k], SELF, *run[k + 1 :]]), *above]
            for run, above in zip(runs, paths, strict=True)
            for k in range(len(run))
        ]
    return paths


def fold(leaf: str, path: list[str]) -> str:
    for run in path:
        leaf = digest(run.replace(SELF, leaf))
    return leaf


def size() -> int:
    return ARITY**BLOCK_LEVELS


def in_blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / size()))


def tops(nodes: DataFrame) -> DataFrame:
    """`tree, pos, n, node`: the top nodes of all superblocks of `nodes (tree, pos, n, node)`."""

    def work(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        n = int(part["n"].iloc[0])
        top = reduced(part["node"].tolist(), n <= size())[-1][0]
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "n": [-(-n // size())], "node": [top]})

    blocks = in_blocks(nodes.select("tree", "pos", "n", "node")).groupBy("tree", "block")
    return blocks.applyInPandas(work, "tree bigint, pos bigint, n bigint, node string")


def finished(nodes: DataFrame, outer: DataFrame, work, schema: str) -> DataFrame:
    """Cogroup the nodes of each superblock with its one row of `outer (tree, block, path, ...)`."""
    left, right = in_blocks(nodes).groupBy("tree", "block"), outer.groupBy("tree", "block")
    return left.cogroup(right).applyInPandas(work, schema)


def outer_paths(ws: Workspace, nodes: DataFrame) -> DataFrame:
    """`tree, block, path, top` of each superblock of `nodes`: its top node's proof in the tree, and the tree's top."""
    above = ws.keep(tops(nodes), "tops")
    largest = above.agg(F.max("n")).first()[0] or 0
    named = above.select("tree", F.col("pos").alias("block"), "node")
    if largest <= 1:
        return named.select("tree", "block", F.expr("cast(array() as array<string>)").alias("path"), F.col("node").alias("top"))

    def work(key: tuple, part: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        levels = reduced(part["node"].tolist(), int(part["n"].iloc[0]) <= size())
        rest = list(outer["path"].iloc[0])
        paths = [p + rest for p in inner_proofs(levels)]
        return pd.DataFrame({"tree": key[0], "block": part["pos"].to_numpy(), "path": paths, "top": outer["top"].iloc[0]})

    schema = "tree bigint, block bigint, path array<string>, top string"
    return ws.keep(finished(above, outer_paths(ws, above), work, schema), "outer")


def manifest(docs: DataFrame, ws: Workspace, tampered: Column | None = None) -> DataFrame:
    """`doc_id, leaf, subroot, root, proof_sha256, folded_root, verified` of every row.

    `tampered` is the text that the rows are verified with; where it is null, the row's own leaf is.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    made = ws.keep(leaves(docs, tampered), "leaves")
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf")]
    ranked = global_rank(ws, made, order, "rank", "ranked", start=0)
    ranked = ranked.withColumn("key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))).drop("source")
    sources = ranked.groupBy("key").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n"))
    sources = global_rank(ws, sources, [F.col("first")], "tree", "sources", start=0)
    placed = lookup(ws, ranked, sources, "key", "inner", staged=True).select(
        "tree", (F.col("rank") - F.col("first")).alias("pos"), "n", F.col("leaf").alias("node"), "changed", "doc_id"
    )
    placed = ws.keep(placed, "placed")
    inside = outer_paths(ws, placed)
    # The subroots are the nodes of one more tree, whose proofs go on where the sources' end.
    roots = inside.where("block = 0").select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("pos"), F.col("top").alias("node"))
    total = sources.agg(F.count(F.lit(1)).alias("n"))
    roots = ws.keep(roots.join(F.broadcast(total)), "subroots")
    across = finished(roots, outer_paths(ws, roots), _whole_paths, "source bigint, rest array<string>, root string")
    # One row per source and one per superblock of leaves.
    outer = lookup(ws, inside.withColumnRenamed("tree", "source"), ws.keep(across, "across"), "source", "inner", staged=True)
    outer = outer.select(
        F.col("source").alias("tree"), "block", F.concat("path", "rest").alias("path"), F.col("top").alias("subroot"), "root"
    )

    def work(key: tuple, part: pd.DataFrame, far: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        own = part["node"].tolist()
        rest, root = list(far["path"].iloc[0]), far["root"].iloc[0]
        paths = [p + rest for p in inner_proofs(reduced(own, int(part["n"].iloc[0]) <= size()))]
        shown = part["changed"].where(part["changed"].notna(), part["node"]).tolist()
        folded = [fold(leaf, path) for leaf, path in zip(shown, paths, strict=True)]
        return pd.DataFrame({
            "doc_id": part["doc_id"].to_numpy(), "leaf": own, "subroot": far["subroot"].iloc[0], "root": root,
            "proof_sha256": [digest("".join(p).replace(SELF, "")) for p in paths], "folded_root": folded,
            "verified": [f == root for f in folded],
        })

    schema = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return finished(placed, outer, work, schema)


def _whole_paths(key: tuple, part: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Of the subroots of one superblock, their whole proofs up to the root."""
    part = part.sort_values("pos")
    levels = reduced(part["node"].tolist(), int(part["n"].iloc[0]) <= size())
    paths = [p + list(outer["path"].iloc[0]) for p in inner_proofs(levels)]
    return pd.DataFrame({"source": part["pos"].to_numpy(), "rest": paths, "root": outer["top"].iloc[0]})


def without_newlines() -> Column:
    """The texts tampered with: every second row by its id's checksum loses its newlines."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(chosen, F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit("")))


def query(docs: DataFrame) -> DataFrame:
    return manifest(docs, Workspace(docs.sparkSession), without_newlines())
