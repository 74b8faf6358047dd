"""Mixing sources to target weights by iterative proportional fitting.

Spark functions only. Documents are summed into (source, language, topic) cells; one factor per
source, language and topic is fitted in turn until the cells' weighted tokens meet all three target
marginals. A document's rate is its cell's weight, scaled so that the expected sample has the wished
number of tokens and no rate is above 1; a hash of its id and text then decides. Cells are summed before the
shuffle, so a hot source is one row per task, and a marginal's factors are one row per value.

Null and missing sources or languages are the value `(none)`; null texts have no tokens. Repeated
rows draw alike, rows without an id each by their text. Documents of a value that a given target
lacks have no weight and are not sampled; target values without documents are passed over, and
targets that contradict each other are met as far as the last sweeps bring them, which `residuals`
shows. An empty table gives an empty result. Extra columns are kept by `sample` as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstack.llm.common import body, word_count
from quillstack.sources.workspace import Workspace

DIMS = ("source", "lang", "topic")
#: Target share of a value: its token share to this power, shares then summing to one.
FLATTENING = {"source": 0.5, "lang": 0.7, "topic": 0.7}
TOLERANCE = 1e-4
MAX_SWEEPS = 60
#: Cells a task works on: tables of the fit are written in as few files as that makes, since every file costs a process
#: on a local or mounted folder, and a fit writes some dozens of tables.
CELLS_PER_TASK = 100_000
#: Expected share of all tokens that the sample holds.
SAMPLE_SHARE = 0.7


def topic_of(text: Column, tokens: Column) -> Column:
    """A coarse topic read off a text's form: tables, symbol-heavy, short, long or plain prose."""
    return (
        F.when(F.regexp_count(text, F.lit(r" \| ")) * 4 > tokens, "table")
        .when(F.regexp_count(text, F.lit("[#*$%&<>]")) * 4 > tokens, "symbols")
        .when(tokens < 64, "short")
        .when(tokens >= 1024, "long")
        .otherwise("prose")
    )


def labelled(docs: DataFrame) -> DataFrame:
    """`docs` with the columns `_source, _lang, _topic, _tokens` the fit works on."""
    text = body()
    named = lambda c: (
        F.coalesce(F.col(c).cast("string"), F.lit("(none)")) if c in docs.columns else F.lit("(none)")
    )
    return (
        docs.withColumn("_tokens", word_count(text))
        .withColumn("_source", named("source"))
        .withColumn("_lang", named("lang"))
        .withColumn("_topic", topic_of(text, F.col("_tokens")))
    )


def flattened(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """Default targets of one marginal: `value, share`."""
    sums = cells.groupBy(F.col(f"_{dim}").alias("value")).agg(F.sum("tokens").alias("t"))
    total = sums.agg(F.sum(F.pow("t", F.lit(power))).alias("all"))
    return sums.join(F.broadcast(total)).select("value", (F.pow("t", F.lit(power)) / F.col("all")).alias("share"))


def tasks_for(cells: DataFrame) -> int:
    """Tasks for a table with at most as many rows as there are cells."""
    return max(1, -(-cells.count() // CELLS_PER_TASK))


def fit(
    cells: DataFrame, ws: Workspace, targets: dict[str, DataFrame], tolerance: float = TOLERANCE,
    max_sweeps: int = MAX_SWEEPS,
) -> DataFrame:
    """Cells with `weight`: the factor their tokens are multiplied with.

    A sweep refits each marginal's factors against the other two and writes them with their goals, so a
    refit joins three small tables; the largest relative change of a factor is observed as they are written.
    """
    tasks = tasks_for(cells)
    total = cells.agg(F.sum("tokens").cast("double").alias("all"))
    goals = {d: targets[d].join(F.broadcast(total)).withColumn("goal", F.col("share") * F.col("all")) for d in DIMS}
    factors = {
        d: ws.keep(goals[d].select(F.col("value").alias(f"_{d}"), "goal", F.lit(1.0).alias(f"f_{d}")), d) for d in DIMS
    }

    def weighted(skip: str | None = None) -> DataFrame:
        out = cells
        for d in DIMS:
            if d != skip:
                out = out.join(factors[d].drop("goal"), f"_{d}")
        return out

    for _ in range(max_sweeps):
        moves = []
        for d in DIMS:
            others = [F.col(f"f_{o}") for o in DIMS if o != d]
            now = weighted(d).groupBy(f"_{d}").agg(F.sum(F.col("tokens") * others[0] * others[1]).alias("now"))
            ratio = F.when(F.col("now") > 0, F.col("goal") / F.col("now")).otherwise(0.0)
            old = factors[d].withColumnRenamed(f"f_{d}", "old")
            fresh = now.join(old, f"_{d}").select(f"_{d}", "goal", ratio.alias(f"f_{d}"), "old")
            seen: dict[str, float] = {}
            move = F.max(F.abs(F.col(f"f_{d}") - F.col("old")) / F.greatest("old", F.lit(1e-300)))
            factors[d] = ws.keep(fresh.coalesce(tasks), d, {"move": move}, seen).drop("old")
            moves.append(seen["move"])
        change = max(moves)
        if change <= tolerance:
            break
    return weighted().withColumn("weight", F.col("f_source") * F.col("f_lang") * F.col("f_topic")).drop(
        *[f"f_{d}" for d in DIMS]
    )


def residuals(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """How well fitted cells meet the marginals: `dim, value, share, reached`, one row per target value."""
    total = cells.agg(F.sum("tokens").alias("all"))
    out = []
    for d in DIMS:
        now = cells.groupBy(F.col(f"_{d}").alias("value")).agg(F.sum(F.col("tokens") * F.col("weight")).alias("now"))
        met = targets[d].join(now, "value", "left").join(F.broadcast(total))
        reached = F.coalesce(F.col("now"), F.lit(0.0)) / F.greatest("all", F.lit(1))
        out.append(met.select(F.lit(d).alias("dim"), "value", "share", reached.alias("reached")))
    return reduce(DataFrame.union, out)


def rates(fitted: DataFrame, share: float, points: int = 40, rounds: int = 4) -> DataFrame:
    """Cells with `rate` = min(1, scale * weight), the scale set so that `share` of all tokens is expected.

    The expected tokens grow with the scale, piece by piece linearly. The scale lies between that
    without the bound 1 and that at which all rates are 1; every pass sums the tokens at a geometric
    grid of scales between and keeps the two around the goal, so weights of any range are told
    apart, and at last the line between the two gives the scale. A share that the cells with a
    weight do not hold keeps all of them.
    """
    weight = F.when(F.col("weight") > 0, F.col("weight"))
    total, plain, reach = fitted.agg(F.sum("tokens"), F.sum(F.col("tokens") * F.col("weight")), F.max(1 / weight)).first()
    if not total or not plain:
        return fitted.withColumn("rate", F.lit(0.0))
    goal = share * total
    low, high = min(goal / plain, reach), reach

    def expected(scales: list[float]) -> list[float]:
        return list(fitted.agg(*[F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("weight") * s)) for s in scales]).first())

    for _ in range(rounds):
        grid = [low * (high / low) ** (k / points) for k in range(points)] + [high]
        sums = expected(grid)
        k = next((k for k, t in enumerate(sums) if t >= goal), points)
        low, high, under, over = grid[max(k - 1, 0)], grid[k], sums[max(k - 1, 0)], sums[k]
        if low >= high:
            break
    scale = high if over <= under else low + (high - low) * min(1.0, max(0.0, (goal - under) / (over - under)))
    return fitted.withColumn("rate", F.least(F.lit(1.0), F.col("weight") * scale))


def sample(
    docs: DataFrame, ws: Workspace, share: float = SAMPLE_SHARE, targets: dict[str, DataFrame] | None = None,
    seed: int = 7,
) -> DataFrame:
    """`docs` with `_source, _lang, _topic, _tokens, _weight, _rate, _kept`."""
    marked = labelled(docs)
    keys = [f"_{d}" for d in DIMS]
    cells = marked.groupBy(*keys).agg(F.sum("_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    cells = ws.keep(cells.coalesce(docs.sparkSession.sparkContext.defaultParallelism), "cells")
    given, tasks = targets or {}, tasks_for(cells)
    goals = {d: ws.keep(given.get(d, flattened(cells, d, FLATTENING[d]).coalesce(tasks)), f"target-{d}") for d in DIMS}
    fitted = ws.keep(fit(cells, ws, goals).coalesce(tasks), "weights")
    rated = ws.keep(rates(fitted, share).coalesce(tasks), "rates").select(
        *keys, F.col("weight").alias("_weight"), F.col("rate").alias("_rate")
    )
    own = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), body())
    draw = F.shiftrightunsigned(own, 11) / F.lit(float(1 << 53))
    return marked.join(rated, keys, "left").withColumn("_kept", F.coalesce(draw < F.col("_rate"), F.lit(False)))


def query(docs: DataFrame) -> DataFrame:
    rows = sample(docs.select("doc_id", "text", "source", "lang"), Workspace(docs.sparkSession))
    return rows.select(
        "doc_id", F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic"),
        F.col("_tokens").alias("n_tokens"), F.col("_weight").alias("weight"), F.col("_rate").alias("rate"),
        F.col("_kept").alias("kept"),
    )
