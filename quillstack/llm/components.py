"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstack.sources.workspace import Workspace


def components(ws: Workspace, links: DataFrame) -> DataFrame:
    """`node, comp` for every node of `links (a, b)`; comp is the smallest node of its component.

    `links` should be a written table, as every round reads it; a link given twice counts once.
    Every round passes the smallest known node along the links and then jumps to what that node
    knows, so paths halve; a round's table is written. The driver sees one count a round. Hubs are
    combined before the shuffle.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).where("a != b")
    known = ws.keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "comp")
    while True:
        told = both.join(known, both["b"] == known["node"]).groupBy("a").agg(F.min("comp").alias("told"))
        heard = known.join(told, known["node"] == told["a"], "left").select(
            "node", "comp", F.least("comp", F.coalesce("told", "comp")).alias("near")
        )
        jump = known.select(F.col("node").alias("near"), F.col("comp").alias("far"))
        fresh = heard.join(jump, "near", "left").select(
            "node", F.least("near", F.coalesce("far", "near")).alias("fresh"), "comp"
        )
        fresh = ws.keep(fresh, "comp")
        moved = not fresh.where("fresh != comp").isEmpty()
        known = fresh.select("node", F.col("fresh").alias("comp"))
        if not moved:
            return known
