"""Joins, orderings and carry-forwards that hold when one key has a third of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstack.sources.workspace import Workspace

HOT_KEYS = 256
TRACKED_KEYS = 10_000


def heavy_keys(df: DataFrame, key: str) -> DataFrame:
    """At most `HOT_KEYS` most frequent values of a string column, as one column.

    A mergeable sketch, so no rows are shuffled. Which keys it names never changes a
    result: it only decides by which of two exact ways a row is joined.
    """
    sketch = F.expr(f"approx_top_k(`{key}`, {HOT_KEYS}, {TRACKED_KEYS})")
    items = df.where(F.col(key).isNotNull()).agg(sketch.alias("top"))
    return items.select(F.explode(F.col("top.item")).alias(key))


def size_estimate(df: DataFrame) -> int:
    """The optimizer's size estimate of a table in bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether a table's size estimate is under the session's broadcast limit."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return size_estimate(df) <= limit


def lookup(
    ws: Workspace, facts: DataFrame, dim: DataFrame, key: str, how: str = "left", staged: bool = False
) -> DataFrame:
    """Join facts of any skew to a table with one row per key (`left` or `inner`).

    A dimension under the broadcast limit is joined as it is, without a shuffle. Beyond it,
    rows of the most frequent keys meet a broadcast of those keys' dimension rows (at most
    `HOT_KEYS`, whatever the data's size), and all other rows are shuffled by key. Rows
    without a key never reach the shuffle. That way reads facts more than once, so they are
    written first unless they are `staged` already.
    """
    if fits_broadcast(dim):
        return facts.join(dim, key, how)
    if not staged:
        facts = ws.keep(facts, f"facts-{key}")
    hot = heavy_keys(facts, key)
    hot_dim = dim.join(F.broadcast(hot), key, "left_semi")
    by_broadcast = facts.join(F.broadcast(hot_dim), key, "inner")
    rest = facts.where(F.col(key).isNotNull()).join(F.broadcast(hot_dim.select(key)), key, "left_anti")
    out = by_broadcast.unionByName(rest.join(dim, key, how))
    if how == "left":
        out = out.unionByName(facts.where(F.col(key).isNull()), allowMissingColumns=True)
    return out


def global_rank(
    ws: Workspace, df: DataFrame, order: Sequence[Column], out: str, name: str, start: Column | int = 1,
    metrics: Mapping[str, Column] | None = None, counts: dict | None = None,
) -> DataFrame:
    """Dense numbers `start, start+1, ...` along a unique sort key, without a one-task window.

    A range-partitioned sort numbers each partition's rows. The table is written once, so
    that the partitions stay as they are; their offsets, one number per partition, are all
    that the driver sees. `metrics` are observed as the table is written and put into `counts`.
    """
    numbered = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    numbered = ws.keep(numbered, name, metrics, counts)
    part = F.shiftright(F.col("_mid"), 33)
    within = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = dict(numbered.groupBy(part.alias("part")).agg(F.max(within) + 1).collect())
    before = accumulate((sizes.get(i, 0) for i in range(max(sizes, default=0))), initial=0)
    offsets = F.split(F.lit(",".join(map(str, before))), ",").cast("array<bigint>")
    start = F.lit(start) if isinstance(start, int) else start
    rank = F.get(offsets, part.cast("int")) + within + start
    return numbered.withColumn(out, rank.cast("bigint")).drop("_mid")


def running_total(
    ws: Workspace, df: DataFrame, order: Sequence[Column], amount: Column, out: str, name: str
) -> DataFrame:
    """Sums of a whole-number `amount` over all rows before each row along a unique sort key.

    As `global_rank`: the sorted table is written once, sums run inside its partitions, and one number
    per partition goes through the driver.
    """
    sorted_rows = df.withColumn("_amount", amount).orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    kept = ws.keep(sorted_rows, name)
    part = F.shiftright(F.col("_mid"), 33)
    sizes = dict(kept.groupBy(part.alias("part")).agg(F.sum("_amount")).collect())
    before = accumulate((sizes.get(i, 0) for i in range(max(sizes, default=0))), initial=0)
    offsets = F.split(F.lit(",".join(map(str, before))), ",").cast("array<bigint>")
    inside = Window.partitionBy(part).orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
    above = F.coalesce(F.sum("_amount").over(inside), F.lit(0))
    return kept.withColumn(out, F.get(offsets, part.cast("int")) + above).drop("_mid", "_amount")


def carry_forward(
    df: DataFrame, group: str, pos: str, value: Column, out: str, chunk_rows: int = 4096
) -> DataFrame:
    """Last non-null `value` at or above each row of its group, in order of `pos`.

    Groups are cut into position chunks, so the largest task is one chunk: rows look
    inside their chunk first and take what the chunks above left only when it has none.
    """
    chunked = df.withColumn("_chunk", F.floor(F.col(pos) / chunk_rows)).withColumn("_value", value)
    inside = Window.partitionBy(group, "_chunk").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    local = chunked.withColumn("_local", F.last("_value", ignorenulls=True).over(inside))

    tails = chunked.groupBy(group, "_chunk").agg(
        F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col(pos))).alias("_tail")
    )
    above = Window.partitionBy(group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(group, "_chunk", F.last("_tail", ignorenulls=True).over(above).alias("_carried"))
    return (
        local.join(carried, [group, "_chunk"], "left")
        .withColumn(out, F.coalesce("_local", "_carried"))
        .drop("_chunk", "_value", "_local", "_carried")
    )
