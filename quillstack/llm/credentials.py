"""Secret scans: fixed patterns, plus weak parts of credentials that stand near their complements.

Spark functions only. One pass over the texts turns every pattern's matches into gap and match
lengths; everything later works on these lengths. Weak access identifiers, weak secrets and
endpoints are reported only if their complementary parts lie within a scope of `SCOPE` code points,
from the end of one to the start of the other: an interval join, done as running values over each
document's parts, so no pairs are made.

Null texts are empty texts; a null doc_id stays null; repeated rows are scanned each for itself;
other columns are ignored. A text without secrets has empty span lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstack.llm.common import body
from quillstack.sources.workspace import Workspace

SCOPE = 300
BLOCK_CHARS = 512
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
# The order of the alternatives decides which part a text position belongs to.
WEAK = (
    r"""https?://[A-Za-z0-9.-]+(?::[0-9]+)?"""
    r"""|(?i:hostname|host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.:-]{4,}"""
    r"""|(?i:access_?key(?:_?id)?|client_?id|account|username|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@-]{4,}"""
    # Whole runs with a digit; they are tried only where a run or the rest of one begins, so in one pass.
    r"""|(?:\G|(?<![A-Za-z0-9+/_-]))(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{20,}"""
)
KINDS = ("assign", "access", "hex", "weak_access", "weak_secret", "weak_endpoint")
PART = "array<struct<pattern:int,kind:int,gap:int,len:int>>"


def _parts(pattern: int, regex: str, kind) -> Column:
    """Matches of one pattern as (gap before the match, match length); kind -1 drops a match later.

    Splitting at the pattern and extracting it find the same matches; the second is done only
    for texts with a match.
    """
    gaps = F.split("text", regex, -1)
    found = F.regexp_extract_all("text", F.lit(regex), F.lit(0))
    part = lambda z: F.struct(
        F.lit(pattern).alias("pattern"),
        kind(z["found"]).cast("int").alias("kind"),
        F.length(z["gaps"]).alias("gap"),
        F.length(z["found"]).alias("len"),
    )
    zipped = F.slice(F.arrays_zip(gaps.alias("gaps"), found.alias("found")), 1, F.size(gaps) - 1)
    return F.when(F.size(gaps) > 1, F.transform(zipped, part)).otherwise(F.expr(f"cast(array() as {PART})"))


def _weak_kind(match: Column) -> Column:
    lower = F.lower(match)
    secret = match.rlike("[A-Za-z]") & match.rlike("[0-9]") & ~match.rlike("^[0-9a-f]{32,}$")
    return (
        F.when(lower.rlike("^(?:https?://|host|endpoint|server)"), 5)
        .when(lower.rlike(r"""^(?:access_?key|client_?id|account|username|login)[a-z_]*["']?\x20*[:=]"""), 3)
        .when(secret, 4)
        .otherwise(-1)
    )


def parts_of(docs: DataFrame) -> DataFrame:
    """`rid, doc_id, parts`: the lengths of all matches; rid numbers the rows."""
    rows = docs.select("doc_id", body().alias("text"))
    kept = lambda m: F.when(F.length(F.regexp_extract(m, "^" + ASSIGN, 1)) >= 8, 0).otherwise(-1)
    arrays = (
        _parts(0, ASSIGN, kept),
        _parts(1, ACCESS, lambda m: F.lit(1)),
        _parts(2, HEX, lambda m: F.lit(2)),
        _parts(3, WEAK, _weak_kind),
    )
    return rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.concat(*arrays).alias("parts"))


def spans_of(parts: DataFrame) -> DataFrame:
    """`rid, kind, start, stop` of all matches that count: base ones, and weak ones not inside a base one."""
    rows = parts.where(F.size("parts") > 0).select("rid", F.posexplode("parts").alias("i", "p"))
    rows = rows.select("rid", "i", "p.pattern", "p.kind", "p.gap", "p.len")
    so_far = Window.partitionBy("rid", "pattern").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("gap").cast("bigint") + F.col("len")).over(so_far)
    spans = rows.withColumn("stop", stop).where("kind >= 0").select(
        "rid", "kind", (F.col("stop") - F.col("len")).alias("start"), "stop"
    )
    # One order and its reverse: both frames end at the row before, so each is one running value.
    rows = Window.partitionBy("rid")
    before = rows.orderBy("start", F.col("kind").desc()).rowsBetween(Window.unboundedPreceding, -1)
    behind = rows.orderBy(F.col("start").desc(), "kind").rowsBetween(Window.unboundedPreceding, -1)
    base = F.col("kind") <= 2
    left = F.max(F.when(base, F.col("stop"))).over(before)
    right = F.min(F.when(base, F.col("start"))).over(behind)
    clear = (F.coalesce(left, F.lit(-1)) <= F.col("start")) & (F.coalesce(right, F.col("stop")) >= F.col("stop"))
    return spans.withColumn("clear", base | clear).where("clear").drop("clear")


def linked(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Spans that are reported: a weak access identifier near a secret, a weak secret near an access
    identifier, an endpoint near both. Hexadecimal runs count as secrets."""
    # The scope is the gap from the end of the earlier span to the start of the later one. Both frames
    # end at the row itself, so each is one running value.
    rows = Window.partitionBy("rid")
    so_far = rows.orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    from_end = rows.orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    reach = lambda *kinds: F.max(F.when(F.col("kind").isin(*kinds), F.col("stop"))).over(so_far)
    ahead = lambda *kinds: F.min(F.when(F.col("kind").isin(*kinds), F.col("start"))).over(from_end)
    has = lambda *kinds: (
        F.coalesce(F.col("start") - reach(*kinds) <= scope, F.lit(False))
        | F.coalesce(ahead(*kinds) - F.col("stop") <= scope, F.lit(False))
    )
    seen = spans.withColumn("access_near", has(1, 3)).withColumn("secret_near", has(0, 2, 4))
    kind = F.col("kind")
    report = (
        (kind <= 2)
        | ((kind == 3) & F.col("secret_near"))
        | ((kind == 4) & F.col("access_near"))
        | ((kind == 5) & F.col("access_near") & F.col("secret_near"))
    )
    return seen.where(report).select("rid", "kind", "start", "stop")


def reported(ws: Workspace, docs: DataFrame, scope: int = SCOPE) -> tuple[DataFrame, DataFrame]:
    """`rid, doc_id, parts` of all rows and `rid, kind, start, stop` of their reported spans.

    The lengths are written once: row numbers then stay what they are if executors are lost.
    """
    parts = ws.keep(parts_of(docs), "secret-parts")
    return parts, linked(spans_of(parts), scope)


def scan(ws: Workspace, docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """`rid, doc_id, found`: per row its reported spans, an array of (start, kind, stop) in this order."""
    parts, spans = reported(ws, docs, scope)
    found = spans.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "stop"))).alias("found"))
    none = F.expr("cast(array() as array<struct<start:bigint,kind:int,stop:bigint>>)")
    all_rows = parts.select("rid", "doc_id").join(found, "rid", "left")
    return all_rows.withColumn("found", F.coalesce("found", none))


def listing(found: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])
    return F.array_join(F.transform(found, one), ",")


def query(docs: DataFrame) -> DataFrame:
    rows = scan(Workspace(docs.sparkSession), docs)
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("bigint")
    return rows.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(listing(F.filter("found", lambda s: s["kind"] <= 2)), 256).alias("base_sha256"),
        listing(F.col("found")).alias("spans"),
    )


def blocks(text: Column) -> Column:
    """A text in blocks of `BLOCK_CHARS` code points, so that a place in it is reached without reading up to it."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK_CHARS}}}"), F.lit(0))


def between(parts: Column, start: Column, stop: Column) -> Column:
    """The code points from `start` to `stop`, exclusive, of a text in `blocks`."""
    first = F.floor(start / BLOCK_CHARS).cast("int")
    count = F.ceil(stop / BLOCK_CHARS).cast("int") - first
    near = F.array_join(F.slice(parts, first + 1, F.greatest(count, F.lit(0))), "")
    return F.substring(near, F.pmod(start, F.lit(BLOCK_CHARS)).cast("int") + 1, (stop - start).cast("int"))


def mask(docs: DataFrame, ws: Workspace, scope: int = SCOPE, sign: str = "[SECRET]") -> DataFrame:
    """`docs` with every reported span replaced by `sign`; columns and row count stay.

    Overlapping spans become one. Only rows with a finding are joined by text; others keep theirs.
    """
    numbered = ws.keep(docs.withColumn("_row", F.monotonically_increasing_id()), "secret-docs")
    keyed = numbered.select(F.col("_row").alias("doc_id"), "text")
    parts, spans = reported(ws, keyed, scope)
    # A span begins a new sign if it starts at or after the end of all spans before it.
    before = Window.partitionBy("rid").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("after", F.coalesce(F.max("stop").over(before), F.lit(0).cast("bigint")))
    cuts = spans.groupBy("rid").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "stop", "after"))).alias("_cuts"),
        F.max("stop").alias("_last"),
    )
    found = parts.select("rid", F.col("doc_id").alias("_row")).join(cuts, "rid").drop("rid")
    hit = numbered.join(found, "_row").withColumn("_blocks", blocks(F.col("text")))
    clean = numbered.join(found.select("_row"), "_row", "left_anti").drop("_row")
    piece = lambda s: F.when(
        s["start"] >= s["after"], F.concat(between(F.col("_blocks"), s["after"], s["start"]), F.lit(sign))
    ).otherwise("")
    rest = between(F.col("_blocks"), F.col("_last"), F.length("text").cast("bigint"))
    text = F.concat(F.array_join(F.transform("_cuts", piece), ""), rest)
    hit = hit.withColumn("text", text)
    if "n_chars" in docs.columns:
        hit = hit.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.unionByName(hit.select(*clean.columns))
