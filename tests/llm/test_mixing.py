import re

import pytest
from pyspark.sql import functions as F

from tastegrid.llm import mixing
from tests.llm.fixtures import hot_rows, odd_rows, table


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(docs):
    """Water filling by hand."""
    sizes = {}
    for d in docs:
        sizes[d[3]] = sizes.get(d[3], 0) + words(d[1])
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    goal, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        level = (goal - sum(2 * sizes[s] for s in capped)) / (sum(weight[s] for s in free) or 1)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in capped else level * weight[s] for s in names}, sizes
        capped |= over


@pytest.mark.parametrize("docs", [odd_rows(), hot_rows(), [(1, "", "en", "a", 0)], []])
def test_takes_come_near_targets(spark, docs):
    got = mixing.mix_sources(table(spark, docs, clashes=True)).collect()
    assert len(got) == len(docs)
    want, sizes = targets(docs)
    taken = {}
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s, n in taken.items():
        assert abs(n - want[s]) <= 1.5 * min(mixing.BLOCK, max(1, sizes[s] / mixing.FINE + 1))


def test_reruns_agree_and_rows_follow(spark):
    docs = table(spark, hot_rows(), clashes=True)
    mixed = mixing.mix_sources(docs)
    a, b = ({(r["doc_id"], r["taken"]) for r in mixing.mix_sources(d).collect()} for d in (docs, docs.repartition(5)))
    assert a == b
    out = mixing.apply_mix(docs, mixed)
    assert out.columns == docs.columns
    per = {r["doc_id"]: r["n"] for r in out.groupBy("doc_id").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    for doc_id, n in a:
        assert per.get(doc_id, 0) == n


def test_cut_text_keeps_white_space(spark):
    docs = table(spark, [(1, " a  b\nc\td e" * 40, "en", "a", 1), (2, "w " * 500, "en", "b", 1), (3, "v " * 700, "en", "c", 1)])
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in mixing.apply_mix(docs, mixing.mix_sources(docs)).collect():
        assert texts[r["doc_id"]].startswith(r["text"])


def test_tiny_sources_keep_their_share(spark):
    docs = [(i, "w " * n, "en", f"s{n:03}", 1) for i, n in enumerate((1, 3, 15, 40, 63))] + [(100, "v " * 3000, "en", "z", 1)]
    got = {r["source"]: r for r in mixing.mix_sources(table(spark, docs)).collect()}
    want, _ = targets(docs)
    for s, r in got.items():
        assert abs(r["taken"] - want[s]) <= 1
    assert got["s015"]["taken"] == 30 and got["s040"]["taken"] == 80


def by_hand(demands, shards):
    """Seats one by one: (blocks, demand) of each source in order -> edges of each source."""
    seats = min(int(sum(d for _, d in demands) + 0.5), sum(2 * b for b, _ in demands))
    given, edges = [0] * len(demands), [[0] for _ in demands]
    houses = [seats * k // shards for k in range(1, shards + 1)]
    for house in houses:
        while sum(given) < house:
            free = [i for i, (b, _) in enumerate(demands) if given[i] < 2 * b]
            given[max(free, key=lambda i: (demands[i][1] / (2 * given[i] + 1), -i))] += 1
        for e, n in zip(edges, given):
            e.append(n)
    return edges


CASES = [
    [(200, 390.7), (80, 33.3), (1, 1.4), (16, 32.0), (300, 111.1)],
    [(10_000, 15_000.0)] + [(1, 0.4)] * 300,  # all but one round down
    [(10_000, 9_000.0)] + [(1, 0.6)] * 300,  # all but one round up
    [(3, 6.0), (4, 8.0), (0, 0.0)],  # all full
    [(50, 30.0)] * 7,  # ties
    [(1, 2.0)],
    [],
]


@pytest.mark.parametrize("demands", CASES)
@pytest.mark.parametrize("shards", [1, 7])
def test_highest_quotients_shard_by_shard(spark, demands, shards):
    rows = [(f"s{i:04}", i, b, d) for i, (b, d) in enumerate(demands)]
    cut = spark.createDataFrame(rows, "source string, place long, blocks long, demand double")
    got = {r["source"]: r["edges"] for r in mixing.shard_quotas(cut, shards).collect()}
    assert got == {f"s{i:04}": e for i, e in enumerate(by_hand(demands, shards))}


def test_shards_share_the_words(spark):
    got = mixing.mix_sources(table(spark, hot_rows()), shards=5).collect()
    for r in got:
        assert len(r["shard_words"]) == 5 and sum(r["shard_words"]) == r["taken"] and min(r["shard_words"]) >= 0
    per = [sum(r["shard_words"][k] for r in got) for k in range(5)]
    assert max(per) - min(per) <= 3 * mixing.BLOCK


def test_level_when_all_sources_are_capped(spark):
    docs = table(spark, [(1, "a b c", "en", "a", 1), (2, "d", "en", None, 1)])
    got = {r["doc_id"]: r["taken"] for r in mixing.mix_sources(docs, share=5.0).collect()}
    assert got == {1: 6, 2: 2}
