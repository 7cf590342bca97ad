import importlib

import pytest

import corpus_pipeline
from tastegrid.llm import jaccard
from tests.conftest import FOLDER
from tests.llm.fixtures import odd_rows, table
from tests.llm.test_jaccard import brute


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert importlib.import_module("__spark_entry__").queries()["pipeline"] is corpus_pipeline.run


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A folder with the odd rows as documents."""
    place = str(tmp_path_factory.mktemp("odd"))
    table(spark, odd_rows(), clashes=True).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([(1, odd_rows()[11][1]), (2, None)], "item_id bigint, text string").write.parquet(f"{place}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    return place


def test_every_stage_takes_odd_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        own = ("shard", "slot") if k == 4 else ()
        assert [c for c in out.columns if c not in own] == [c for c in docs.columns if c not in own], name
        assert out.count() > 0, name
        assert stage(spark, docs.limit(0), folder).count() == 0, name


def test_run(spark):
    out = corpus_pipeline.run(spark, FOLDER).collect()
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    texts = {r["doc_id"]: r["text"] for r in documents}
    assert out and all(texts[r["doc_id"]].startswith(r["text"]) for r in out)
    groups = {d: c for d, _, c in brute([(r["doc_id"], r["text"]) for r in documents])}
    kept = {r["doc_id"] for r in out}
    assert len({groups[d] for d in kept}) == len(kept)  # no two of a group
    assert jaccard.keep_one(spark.createDataFrame([(d, texts[d]) for d in kept], "doc_id bigint, text string")).count() == len(kept)
    sizes = [sum(r["shard"] == s for r in out) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1
