"""The joins, numberings and carry-forwards for hot keys against their plain forms."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quillstack.operators import skew
from quillstack.sources.workspace import Workspace, checkpoint_root


@pytest.fixture()
def ws(spark):
    return Workspace(spark)


@pytest.fixture()
def facts(spark):
    """A third of the rows share one key, some have none, some have no partner."""
    rnd = random.Random(7)
    keys = ["hot"] * 700 + [None] * 50 + [f"k{rnd.randint(0, 400)}" for _ in range(1400)]
    return spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, key string")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("small", [True, False])
def test_lookup(spark, ws, facts, monkeypatch, how, small):
    dim = spark.createDataFrame([("hot", -1)] + [(f"k{i}", i) for i in range(300)], "key string, value int")
    monkeypatch.setattr(skew, "fits_broadcast", lambda df: small)
    monkeypatch.setattr(skew, "HOT_KEYS", 5)
    got = skew.lookup(ws, facts, dim, "key", how).select("id", "key", "value").collect()
    want = facts.join(dim, "key", how).select("id", "key", "value").collect()
    assert sorted(got, key=lambda r: r["id"]) == sorted(want, key=lambda r: r["id"])


def test_heavy_keys_finds_the_hot_key_and_is_bounded(facts, monkeypatch):
    monkeypatch.setattr(skew, "HOT_KEYS", 5)
    found = [r["key"] for r in skew.heavy_keys(facts, "key").collect()]
    assert "hot" in found and len(found) == 5


def test_size_check(spark, ws, facts):
    assert skew.fits_broadcast(ws.keep(facts, "facts"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not skew.fits_broadcast(facts)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("partitions", [1, 3, 20])
def test_global_rank(spark, ws, partitions):
    values = list(range(997))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v % 13, v) for v in values], "a int, b int").repartition(partitions)
    ranked = skew.global_rank(ws, df, [F.col("a"), F.col("b").desc()], "n", "test", 101)
    window = Window.orderBy("a", F.col("b").desc())
    plain = df.withColumn("n", (F.row_number().over(window) + 100).cast("bigint"))
    assert sorted(ranked.collect()) == sorted(plain.collect())


def test_global_rank_of_nothing(spark, ws):
    df = spark.createDataFrame([], "a int")
    assert skew.global_rank(ws, df, [F.col("a")], "n", "empty").collect() == []


@pytest.mark.parametrize("chunk", [1, 7, 4096])
def test_carry_forward(spark, chunk):
    rnd = random.Random(3)
    rows = [(g, p, p if rnd.random() < 0.1 else None) for g in ("a", "b", "hot") for p in range(3000 if g == "hot" else 50)]
    df = spark.createDataFrame(rows, "g string, p bigint, v bigint").repartition(5)
    got = skew.carry_forward(df, "g", "p", F.col("v"), "last", chunk_rows=chunk).select("g", "p", "last")
    above = Window.partitionBy("g").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("g", "p", F.last("v", ignorenulls=True).over(above).alias("last"))
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_workspace_reads_the_session_folder(spark, ws):
    assert ws.root.startswith(spark.conf.get("spark.checkpoint.dir"))


class NamelessSession:
    """A session without a checkpoint folder."""

    def __init__(self, master):
        self.conf = {"spark.master": master}


def test_workspace_without_a_folder():
    assert checkpoint_root(NamelessSession("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(NamelessSession("yarn"))
