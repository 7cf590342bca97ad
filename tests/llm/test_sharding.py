import zlib

from pyspark.sql import functions as F

from tastegrid.llm import sharding
from tests.llm.fixtures import hot_rows, odd_rows, table


def shards_of(df, shards):
    rows = df.collect()
    sizes = [0] * shards
    slots = {}
    for r in rows:
        sizes[r["shard"]] += 1
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return rows


def test_odd_rows(spark):
    docs = odd_rows()
    rows = shards_of(sharding.assign_shards(table(spark, docs, clashes=True), 4), 4)
    assert len(rows) == len(docs)
    texts = sorted(((r[1] or "") for r in docs))
    expected = sorted((len(t.encode()) + 1, zlib.crc32(t.encode())) for t in texts)
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == expected


def test_equal_texts_stay_together_unless_too_many(spark):
    docs = hot_rows()
    rows = shards_of(sharding.assign_shards(table(spark, docs), 4), 4)
    by_id = {r["doc_id"]: r["shard"] for r in rows}
    hot = [by_id[i] for i in range(60)]  # 60 of 180 rows, 45 fit a shard
    assert len(set(hot)) == 2


def test_propagation_mends_a_bad_start(spark):
    # two links cross: nodes in several links follow the majority of their neighbours
    links = [(n, n // 6) for n in range(48)] + [(n, 100 + n // 12) for n in range(48)]
    nodes = spark.range(96).select(F.col("id").alias("node"))
    found = sharding.propagate(nodes, spark.createDataFrame(links, "node bigint, link bigint"), 4)
    shard = {r["node"]: r["shard"] for r in found.collect()}
    assert sorted(list(shard.values()).count(s) for s in range(4)) == [24] * 4
    cut = sum(len({shard[n] for n in range(g * 6, g * 6 + 6)}) > 1 for g in range(8))
    assert cut == 0


def test_empty(spark):
    assert sharding.assign_shards(table(spark, []), 4).count() == 0
    assert sharding.with_shards(table(spark, []), 4).count() == 0


def test_with_shards_keeps_all_rows_and_columns(spark):
    docs = table(spark, odd_rows(), clashes=True)
    out = sharding.with_shards(docs, 4)
    assert out.count() == docs.count()
    assert [c for c in out.columns if c not in ("shard", "slot")] == [c for c in docs.columns if c not in ("shard", "slot")]
