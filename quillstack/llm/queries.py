"""The registered queries of this folder and the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillstack.llm import (
    chunks, credentials, fingerprint, katz, lines, merkle, mixing, neardup, packing, periods, pii, quality, urltree,
)
from quillstack.llm.common import table

OPERATORS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "op1_paragraph_sketch": (fingerprint.query, ("documents",)),
    "op2_gear_chunks": (chunks.query, ("documents",)),
    "op3_path_templates": (urltree.query, ("pages",)),
    "op4_probminhash": (neardup.query, ("documents",)),
    "op5_raked_mix": (mixing.query, ("documents",)),
    "op6_conflict_packing": (packing.query, ("documents",)),
    "op7_line_rules": (lines.query, ("documents",)),
    "op8_additive_quality": (quality.query, ("documents", "labels")),
    "op9_linked_secrets": (credentials.query, ("documents",)),
    "op10_shape_crf": (pii.query, ("documents",)),
    "op11_katz_backoff": (katz.query, ("documents",)),
    "op12_merkle_manifest": (merkle.query, ("documents",)),
    "op13_periodic_runs": (periods.query, ("documents",)),
}


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(make: Callable[..., DataFrame], tables: tuple[str, ...]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: make(*[table(spark, sf_dir, t) for t in tables])

    return {name: bound(make, tables) for name, (make, tables) in OPERATORS.items()}


def oracles() -> dict[str, str]:
    return {"op7_line_rules": lines.SQL}
