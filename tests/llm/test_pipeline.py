"""The pipeline's stages, each on its predecessor's result."""

import corpus_pipeline
from quillstack.llm import packing
from quillstack.llm.common import table
from quillstack.sources.workspace import Workspace

SF_DIR = "/root/testdata/sf0.01"


def stages(spark, docs):
    """Every stage's result on a table, the last one's last."""
    ws, out = Workspace(spark), {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = docs = ws.keep(stage(spark, docs, SF_DIR), name)
    return out


def test_odd_rows(spark, odd):
    out = stages(spark, odd)
    rows = lambda name: [tuple(r) for r in out[name].select("doc_id", "text").collect()]
    given = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    assert all(out[name].columns == odd.columns for name in list(out)[:-1])
    assert set(rows("quality")) <= set(given)
    kept = rows("near_duplicates")
    assert len({t or "" for _, t in kept}) == len(kept) and set(kept) <= set(rows("quality"))
    assert len(rows("secrets")) == len(kept) and set(rows("mixing")) <= set(rows("secrets"))
    packed = out["packing"].groupBy("doc_id").sum("n_tokens").collect()
    tokens = {d: len((t or "").encode().split()) for d, t in rows("mixing")}
    assert {r["doc_id"]: r["sum(n_tokens)"] for r in packed} == tokens


def test_empty_tables(spark, empty):
    assert [df.count() for df in stages(spark, empty).values()] == [0] * 5


def test_stages(spark):
    ws = Workspace(spark)
    docs = table(spark, SF_DIR, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, ws.keep(stage(spark, docs, SF_DIR), name)
        kept[name] = docs
        if name != "packing":
            assert docs.columns == columns
            assert docs.join(before, "doc_id", "left_anti").isEmpty()
    quality = {r["doc_id"]: r["quality"] for r in table(spark, SF_DIR, "labels").collect()}
    good = {r["doc_id"] for r in kept["quality"].select("doc_id").collect()}
    assert all(d in good for d, q in quality.items() if q == 1)
    poor = [d for d, q in quality.items() if q == 0]
    assert sum(d in good for d in poor) <= 0.1 * len(poor)
    assert kept["near_duplicates"].count() < kept["quality"].count() == len(good)
    assert kept["near_duplicates"].select("text").distinct().count() == kept["near_duplicates"].count()
    masked = kept["secrets"]
    assert masked.count() == kept["near_duplicates"].count()
    assert masked.where("text rlike '[0-9a-f]{32,}' and text not like '%[SECRET]%'").isEmpty()
    mixed = {r["doc_id"] for r in kept["mixing"].select("doc_id").collect()}
    assert {r["doc_id"] for r in docs.select("doc_id").collect()} == mixed
    assert docs.groupBy("shard", "bin").sum("n_tokens").where(f"`sum(n_tokens)` > {packing.CAPACITY}").isEmpty()
