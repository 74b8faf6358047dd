"""Document fingerprints: invertible Bloom lookup sketches of hashed paragraphs.

A sketch has three sub-tables of `WIDTH` cells; a paragraph digest adds to one cell of each a count,
itself and a check value (the last two by exclusive or). Two sketches subtract cell by cell, and
peeling the difference recovers the digests only one version has. Where peeling stalls, the sketch
is made four times as large: the digests are dealt to four sketches by two of their bits, again and
again; after `LEVELS` of these, sets are compared as they are. So the work follows the number of
paragraphs, and a sketch in a row stays small.

Spark functions only. The texts are shuffled once, by ranges of doc_id, so that every document meets
the next one; all later steps group by keys that contain this partitioning and need no shuffle.

A paragraph is a non-empty line, and equal lines of a text count once. Null texts are empty texts.
Rows are ordered by doc_id (nulls first), ties by text; repeated rows follow each other, and each is
the other's next document. A lone row is its own next document. Two empty texts have likeness 1.
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstack.llm.common import body

WIDTH = 8
LEVELS = 4
ROUNDS = 8
#: Ranges of doc_id are cut at so many quantiles at most, whatever the table's size.
MAX_BLOCKS = 4096
ROWS_PER_BLOCK = 64

CELLS = 3 * WIDTH
CELL = "struct<c:int,k:bigint,h:bigint>"
# Each digest's hash holds its three places (3 bits each) and, in the upper half, its check value.
PLACE_BITS = 3


def digests(text: Column) -> Column:
    """Distinct digests of the paragraphs of a text."""
    lines = F.filter(F.split(text, "\n"), lambda p: p != "")
    return F.array_distinct(F.transform(lines, lambda p: F.xxhash64(p)))


def _keyed(key: str, count: str) -> str:
    """SQL of a key with its count, check value and the cell it has in each sub-table."""
    q = f"xxhash64({key}, 7)"
    cells = ", ".join(f"'p{t}', cast(shiftright({q}, {PLACE_BITS * t}) & {WIDTH - 1} as int)" for t in range(3))
    return f"named_struct('c', {count}, 'k', {key}, 'h', shiftrightunsigned({q}, 32), {cells})"


def _added(keys: str, cell: str, sign: str, table: int, index: str) -> str:
    """SQL of one cell of a sub-table after adding (or taking away) the keys that fall into it."""
    step = f"(a, x) -> named_struct('c', a.c {sign} x.c, 'k', a.k ^ x.k, 'h', a.h ^ x.h)"
    return f"aggregate(filter({keys}, x -> x.p{table} = {index}), {cell}, {step})"


def sketch(keys: str) -> str:
    """SQL of the sketch of an array of digests: `CELLS` cells, one sub-table after the other."""
    zero = "named_struct('c', 0, 'k', 0L, 'h', 0L)"
    tables = [f"transform(sequence(0, {WIDTH - 1}), i -> {_added('keys', zero, '+', t, 'i')})" for t in range(3)]
    return f"transform(array(transform({keys}, u -> {_keyed('u', '1')})), keys -> concat({', '.join(tables)}))[0]"


def subtract(a: str, b: str) -> str:
    cell = "named_struct('c', x.c - y.c, 'k', x.k ^ y.k, 'h', x.h ^ y.h)"
    return f"zip_with({a}, {b}, (x, y) -> {cell})"


def peel(cells: str) -> str:
    """SQL of `struct<cells, plus, minus, live>` after peeling a difference; done if all cells are empty."""
    check = "x.h = shiftrightunsigned(xxhash64(x.k, 7), 32)"
    pure = (
        f"array_distinct(transform(filter(s.cells, x -> abs(x.c) = 1 and {check}), x -> {_keyed('x.k', 'x.c')}))"
    )
    tables = [
        f"transform(slice(s.cells, {1 + WIDTH * t}, {WIDTH}), (cell, i) -> {_added('pure', 'cell', '-', t, 'i')})"
        for t in range(3)
    ]
    state = (
        "named_struct("
        f"'cells', concat({', '.join(tables)}), "
        "'plus', concat(s.plus, transform(filter(pure, p -> p.c = 1), p -> p.k)), "
        "'minus', concat(s.minus, transform(filter(pure, p -> p.c = -1), p -> p.k)), "
        "'live', size(pure) > 0)"
    )
    none = "cast(array() as array<bigint>)"
    start = f"named_struct('cells', {cells}, 'plus', {none}, 'minus', {none}, 'live', true)"
    busy = "s.live and exists(s.cells, x -> x.c != 0 or x.k != 0)"
    step = f"(s, r) -> if({busy}, transform(array({pure}), pure -> {state})[0], s)"
    return f"aggregate(sequence(1, {ROUNDS}), {start}, {step})"


def as_text(cells: str) -> str:
    """A sketch as text: base64 of count, key and check of every cell."""
    byte_hex = "concat(lpad(hex(x.c & 65535), 4, '0'), lpad(hex(x.k), 16, '0'), lpad(hex(x.h), 8, '0'))"
    return f"replace(base64(unhex(array_join(transform({cells}, x -> {byte_hex}), ''))), '\\r\\n', '')"


def with_next(docs: DataFrame, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """`block, rid, doc_id, text, digests, next_text, next_digests`, hash partitioned by block.

    Blocks are ranges between quantiles of doc_id; each quantile is a doc_id of the table and so
    the first of its block, which is also sent to the block before as its last neighbour.
    """
    rows = docs.select("doc_id", body().alias("text"))
    low, n = rows.agg(F.min("doc_id"), F.count("doc_id")).first()
    blocks = max(1, min(max_blocks, n // ROWS_PER_BLOCK))
    cuts = []
    if n:
        probs = [k / blocks for k in range(1, blocks)]
        cut = F.percentile_approx("doc_id", probs or [0.5], 10 * max_blocks)
        cuts = sorted({low, *(rows.agg(cut).first()[0] if probs else [])})
    if not cuts:
        cuts = [0]
    bounds = f"array({', '.join(f'{c}L' for c in cuts)})"
    # Binary search for the last bound at or below doc_id; the searched array is a constant of bounded length.
    top = 1 << (len(cuts).bit_length() - 1)
    steps = f"filter(array({', '.join(str(top >> k) + 'L' for k in range(top.bit_length()))}), b -> true)"
    found = (
        f"aggregate({steps}, 0L, (at, b) -> if(at + b < {len(cuts)} and "
        f"element_at({bounds}, cast(at + b + 1 as int)) <= doc_id, at + b, at))"
    )
    block = F.coalesce(F.expr(found), F.lit(0))
    placed = rows.withColumn("block", block)
    has_null = n and not rows.where("doc_id is null").isEmpty()
    first = F.col("doc_id").isNull() if has_null else F.col("doc_id").eqNullSafe(F.lit(cuts[0] if n else None))
    opens = (F.col("doc_id") == F.expr(f"element_at({bounds}, cast(block + 1 as int))")) & (F.col("block") > 0)
    # (block, 0): the row itself; (block, 1): a copy that only serves as the neighbour of another row.
    copies = F.filter(
        F.array(
            F.struct(F.col("block").alias("b"), F.lit(0).alias("edge")),
            F.when(opens, F.struct((F.col("block") - 1).alias("b"), F.lit(1).alias("edge"))),
            F.when(first, F.struct(F.lit(len(cuts) - 1).cast("bigint").alias("b"), F.lit(2).alias("edge"))),
        ),
        lambda c: c.isNotNull(),
    )
    dealt = placed.withColumn("copy", F.explode(copies)).select(
        F.col("copy.b").alias("block"), F.col("copy.edge").alias("edge"), "doc_id", "text"
    )
    order = Window.partitionBy("block").orderBy("edge", F.col("doc_id").asc_nulls_first(), "text")
    near = dealt.withColumn("next_text", F.lead("text").over(order)).withColumn("rid", F.row_number().over(order))
    return near.where("edge = 0").drop("edge")


def fingerprints(docs: DataFrame) -> DataFrame:
    """`doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    n_removed, n_added`: the last two count the paragraphs only the text or only its edited text has.
    """
    rows = with_next(docs)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half)
    )
    rows = rows.select(
        "block", "rid", "doc_id", F.length("text").cast("bigint").alias("n_chars"), edited.alias("edited"),
        digests(F.col("text")).alias("own"), digests(F.col("next_text")).alias("next"),
    )
    rows = rows.select(
        "block", "rid", "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        "own", digests(F.col("edited")).alias("edited"), "next",
    )
    rows = rows.withColumns({f"{c}_cells": F.expr(sketch(c)) for c in ("own", "edited", "next")})
    for other in ("edited", "next"):
        rows = decoded(rows, other)
    union = lambda o: F.size(o) + F.col(f"{o}_removed")
    near = lambda o: F.when(union(o) == 0, 1.0).otherwise(
        (F.size("own") - F.col(f"{o}_removed")) / union(o)
    )
    return rows.select(
        "doc_id", "n_chars", "edited_sha256",
        F.expr(as_text("own_cells")).alias("fingerprint"),
        F.expr(as_text("edited_cells")).alias("edited_fingerprint"),
        near("edited").alias("near_edited"), near("next").alias("near_next"),
        F.col("edited_removed").alias("n_removed"), F.col("edited_added").alias("n_added"),
    )


def decoded(rows: DataFrame, other: str) -> DataFrame:
    """Adds `{other}_removed` and `{other}_added`: how many digests only `own` or only `other` has.

    `_todo` lists the pairs of digest sets whose difference is not peeled yet. The first try uses the
    fingerprints themselves; a stalled pair is dealt to four, and so on.
    """
    empty = "forall(r.s.cells, x -> x.c = 0 and x.k = 0 and x.h = 0)"
    tried = f"transform(_todo, t -> named_struct('a', t.a, 'b', t.b, 's', {peel(subtract(sketch('t.a'), sketch('t.b')))}))"
    summed = lambda rows, sign: F.expr(
        f"aggregate(filter({rows}, r -> {empty}), 0, (n, r) -> n + size(r.s.{sign}))"
    )
    first = f"array(named_struct('a', own, 'b', {other}, 's', {peel(subtract('own_cells', f'{other}_cells'))}))"
    rows = rows.withColumn("_tried", F.expr(first))
    removed, added = f"{other}_removed", f"{other}_added"
    rows = rows.withColumn(removed, F.lit(0)).withColumn(added, F.lit(0))
    for level in range(LEVELS + 1):
        part = lambda c, k: f"filter(r.{c}, u -> (shiftright(u, {2 * level}) & 3) = {k})"  # noqa: E731,B023
        quarters = ", ".join(f"named_struct('a', {part('a', k)}, 'b', {part('b', k)})" for k in range(4))
        rows = rows.select(
            *[c for c in rows.columns if c not in (removed, added, "_tried")],
            (F.col(removed) + summed("_tried", "plus")).alias(removed),
            (F.col(added) + summed("_tried", "minus")).alias(added),
            F.expr(f"flatten(transform(filter(_tried, r -> not {empty}), r -> array({quarters})))").alias("_todo"),
        )
        if level < LEVELS:
            rows = rows.withColumn("_tried", F.expr(tried)).drop("_todo")
    left = lambda a, b: F.expr(f"aggregate(_todo, 0, (n, t) -> n + size(array_except(t.{a}, t.{b})))")
    return rows.withColumns(
        {removed: F.col(removed) + left("a", "b"), added: F.col(added) + left("b", "a")}
    ).drop("_todo")


def query(docs: DataFrame) -> DataFrame:
    return fingerprints(docs)
