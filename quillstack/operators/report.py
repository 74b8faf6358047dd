"""Run summaries as one-row tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def rows() -> Column:
    return F.count(F.lit(1))


def one_row(spark: SparkSession, counts: Mapping[str, int], names: Sequence[str]) -> DataFrame:
    """One row of counts that were observed while the tables were written; nothing is scanned for it."""
    return spark.createDataFrame([tuple(int(counts[n]) for n in names)], ", ".join(f"{n} bigint" for n in names))
