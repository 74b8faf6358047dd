"""URL filters: rules first, then a path-template tree per host with labelled purities.

Spark functions only. Rules label the urls they fit. All urls of a host form a tree of path
segments; level by level, positions with many values become wildcards, and branches whose share of
blocked urls does not differ from their siblings' merge. A url no rule fits is blocked if the
smoothed share of blocked urls of its template reaches `purity`; the smoothing draws it towards the
host's share, and that towards the share of the same template over all hosts.

A null url, or one without `://`, has an empty host and path. Null page ids stay null, repeated rows
are judged each for itself, other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstack.sources.workspace import Workspace

RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
#: Levels of the tree; what lies deeper is one further segment.
DEPTH = 4
#: A position with more values than this is variable when they also average under `REPEATS` urls.
FANOUT = 8
REPEATS = 20
#: Sibling branches merge while their blocked shares differ by fewer standard errors than this.
SIMILAR_Z = 1.96
SMOOTHING = 4.0
PURITY = 0.5


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for urls without `://`."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest fitting rule and its action, else nulls."""
    by_length = sorted(rules, key=lambda r: (-len(r[0]), r[0]))
    fits = []
    for rule, action in by_length:
        name, slash, start = rule.partition("/")
        same = (host == name) | host.endswith("." + name)
        fits.append((same & path.startswith(slash + start), rule, action))
    if not fits:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    pick = lambda k: reduce(lambda c, f: c.when(f[0], f[k]), fits[1:], F.when(fits[0][0], fits[0][k]))
    return pick(1), pick(2)


def segments(path: Column, depth: int) -> Column:
    """Path segments without empty ones, padded to `depth` + 1 places; the last place holds the rest."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    places = [F.coalesce(F.get(parts, i), F.lit("")) for i in range(depth)]
    rest = F.array_join(F.slice(parts, depth + 1, F.greatest(F.size(parts), F.lit(1))), "/")
    return F.array(*places, rest)


def _shape(segment: Column) -> Column:
    """A segment with its digit runs and long hexadecimal or opaque runs as wildcards."""
    opaque = F.regexp_replace(segment, r"[0-9A-Fa-f]{8,}(?:-[0-9A-Fa-f]{4,})*", "*")
    return F.regexp_replace(opaque, r"[0-9]+", "*")


def template_tree(urls: DataFrame, ws: Workspace, depth: int = DEPTH, fanout: int = FANOUT, repeats: int = REPEATS):
    """`host, segs, template` for the distinct urls `(host, segs, n, blocked, labelled)`.

    Every level is one aggregation of branches and one of their parents, so a hot host is
    combined before it is shuffled. A level's table is written, which keeps plans short.
    """
    grown = urls.withColumn("template", F.lit(""))
    for level in range(depth + 1):
        grown = grown.withColumn("_seg", F.get("segs", F.lit(level)))
        branch = grown.groupBy("host", "template", "_seg").agg(
            F.sum("n").alias("n"), F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled")
        )
        parent = branch.groupBy("host", "template").agg(
            F.count(F.lit(1)).alias("values"), F.sum("n").alias("urls"),
            F.sum("blocked").alias("all_blocked"), F.sum("labelled").alias("all_labelled"),
        )
        variable = (F.col("values") > fanout) & (F.col("urls") < repeats * F.col("values"))
        share = F.col("all_blocked") / F.greatest("all_labelled", F.lit(1))
        error = F.sqrt(F.greatest(share * (1 - share), F.lit(1e-9)) / F.greatest("labelled", F.lit(1)))
        differs = (F.col("labelled") > 0) & (
            F.abs(F.col("blocked") / F.greatest("labelled", F.lit(1)) - share) >= SIMILAR_Z * error
        )
        named = (
            F.when(F.col("_seg") == "", "")
            .when(differs, F.concat(F.lit("/"), _shape(F.col("_seg"))))
            .when(variable, F.lit("/*"))
            .otherwise(F.concat(F.lit("/"), _shape(F.col("_seg"))))
        )
        steps = branch.join(parent, ["host", "template"]).select("host", "template", "_seg", named.alias("_step"))
        grown = grown.join(steps, ["host", "template", "_seg"]).withColumn("template", F.concat("template", "_step"))
        grown = ws.keep(grown.drop("_seg", "_step"), f"url-level-{level}")
    return grown


def judge(
    pages: DataFrame, rules=RULES, purity: float = PURITY, smoothing: float = SMOOTHING, depth: int = DEPTH
) -> DataFrame:
    """`page_id, host, path, rule, verdict, template, blocked_share` of every row of `pages (page_id, url)`."""
    ws = Workspace(pages.sparkSession)
    host, path = host_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("action", action).withColumn("segs", segments(F.col("path"), depth))
    urls = rows.groupBy("host", "segs").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("action") == "block").alias("blocked"),
        F.count("action").alias("labelled"),
    )
    tree = template_tree(urls, ws, depth)

    def counts(keys, name):
        return tree.groupBy(*keys).agg(
            F.sum("blocked").alias(f"{name}_blocked"), F.sum("labelled").alias(f"{name}_labelled")
        )

    smooth = lambda name, prior: (
        (F.col(f"{name}_blocked") + smoothing * prior) / (F.col(f"{name}_labelled") + smoothing)
    )
    every = tree.agg(F.sum("blocked").alias("every_blocked"), F.sum("labelled").alias("every_labelled"))
    rate = (F.coalesce("every_blocked", F.lit(0)) + 1) / (F.coalesce("every_labelled", F.lit(0)) + 2)
    shared = counts(["template"], "shared").join(F.broadcast(every.select(rate.alias("rate"))))
    shared = shared.select("template", smooth("shared", F.col("rate")).alias("shared_share"))
    hosts = counts(["host"], "host")
    own = counts(["host", "template"], "own")
    share = own.join(hosts, "host").join(shared, "template")
    share = share.withColumn("host_share", smooth("host", F.col("shared_share")))
    share = share.select("host", "template", smooth("own", F.col("host_share")).alias("blocked_share"))
    known = tree.select("host", "segs", "template").join(share, ["host", "template"])
    verdict = F.coalesce("action", F.when(F.col("blocked_share") >= purity, "block").otherwise("allow"))
    return rows.join(known, ["host", "segs"], "left").select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "blocked_share"
    )


def query(pages: DataFrame) -> DataFrame:
    return judge(pages)
