"""Written intermediate tables: they cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Compression of kept tables; whole bodies go through them, which it holds in about half the bytes of the default.
CODEC = "zstd"
#: Most buckets that Spark allows a table by default.
MAX_BUCKETS = 100_000


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; local sessions without one get their own."""
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root:
        return root
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    return tempfile.mkdtemp(prefix="quillstack-")


class Workspace:
    """Folder of one run; `keep` writes a table there and reads it back.

    Tables are Parquet rather than RDD checkpoints, so later stages still prune
    columns and push filters into them.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = f"{(root or checkpoint_root(spark)).rstrip('/')}/quillstack-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def keep(
        self, df: DataFrame, name: str, metrics: Mapping[str, Column] | None = None, counts: dict | None = None
    ) -> DataFrame:
        """`df` written and read back; `metrics` are observed while it is written and put into `counts`."""
        path, seen = self.path(name), Observation()
        written = df.observe(seen, *[m.alias(k) for k, m in metrics.items()]) if metrics else df
        written.write.mode("errorifexists").parquet(path, compression=CODEC)
        if metrics:
            counts.update({k: seen.get[k] or 0 for k in metrics})
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_by(self, df: DataFrame, name: str, key: str) -> DataFrame:
        """As `keep`, bucketed by a column: later joins and groups by it leave these rows where they are.

        The table is entered in the session's catalog, as a path alone does not tell of its buckets.
        """
        table = f"quillstack_{uuid.uuid4().hex}"
        buckets = min(int(self.spark.conf.get("spark.sql.shuffle.partitions")), MAX_BUCKETS)
        writer = df.write.format("parquet").bucketBy(buckets, key).sortBy(key)
        writer.option("path", self.path(name)).option("compression", CODEC).saveAsTable(table)
        return self.spark.table(table)
