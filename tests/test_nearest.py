"""The exact kernel against brute force: heads in chunks, equal vectors once, small embeddings."""

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tastegrid.operators import nearest, recommending, retrieval
from tastegrid.plans import retrieving


def listed(rows):
    kind = pa.struct([("dense", pa.list_(pa.float64())), ("slots", pa.list_(pa.int32())), ("weights", pa.list_(pa.float64()))])
    return nearest._Vectors(pa.array([dict(zip(("dense", "slots", "weights"), r)) for r in rows], kind))


class Asked:
    k, digits, exclude_same, min_score = 3, 9, False, None


def test_heads_are_left_out_by_norm_and_ranges_are_exact(monkeypatch):
    monkeypatch.setattr(nearest, "CHUNK", 16)
    rng = np.random.default_rng(3)
    docs = rng.normal(size=(400, 4)) * np.exp(rng.normal(size=(400, 1)) * 2)
    asked = rng.normal(size=(20, 4))
    wave = nearest._Wave(np.arange(400), listed([(list(v), [], []) for v in docs]))
    queries = listed([(list(v), [], []) for v in asked])
    places, scores = wave.head_best(queries.dense, None, Asked(), np.full(20, -1), 3, wave.chunks)
    made = np.round(asked @ docs.T, 9)
    assert (places == np.argsort(-made, axis=1, kind="stable")[:, :3]).all()
    reach = wave.reach(queries.dense)
    whole = asked @ docs.T
    assert np.allclose(reach, np.stack([whole.min(axis=1), whole.max(axis=1)], axis=1), rtol=0, atol=1e-12)
    assert wave.scored < 0.5 * 3 * made.size  # three passes, most of the chunks left out


def test_heads_with_tails_and_ranked_documents(monkeypatch):
    monkeypatch.setattr(nearest, "CHUNK", 16)
    monkeypatch.setattr(nearest, "PAIR_NUMBERS", 50)
    rng = np.random.default_rng(4)
    heads, tails = rng.integers(-3, 4, (200, 3)) / 4, rng.integers(-2, 3, (200, 6)) * (rng.random((200, 6)) < 0.4)
    rows = [(list(h), list(np.flatnonzero(t)), list(t[np.flatnonzero(t)].astype(float))) for h, t in zip(heads, tails)]
    ranked = rng.random(200) < 0.5
    rows[0] = (rows[0][0], rows[0][1] * 2, rows[0][2] * 2)  # a slot named twice counts once
    wave = nearest._Wave(np.arange(200), listed(rows), ranked)
    rows[0] = (rows[0][0], rows[0][1][: len(rows[0][1]) // 2], rows[0][2][: len(rows[0][2]) // 2])
    queries = listed(rows[:30])
    places, scores = wave.head_best(queries.dense, wave.contents(wave.tails(queries)), Asked(), np.full(30, -1), 3, wave.chunks)
    made = np.where(ranked, heads[:30] @ heads.T + tails[:30] @ tails.T, -np.inf)
    assert (places == np.argsort(-np.round(made, 9), axis=1, kind="stable")[:, :3]).all()


def test_equal_vectors_travel_k_times(spark):
    rows = [(f"i{i:03}", [1.0, float(i % 4)]) for i in range(100)]
    docs = spark.createDataFrame(rows, "id string, vector array<double>")
    kept = defaultdict(list)
    for r in nearest.thinned(docs, 3, "id").collect():
        kept[r["vector"][1]].append(r["id"])
    assert {v: sorted(ids) for v, ids in kept.items()} == {float(v): [f"i{v + 4 * n:03}" for n in range(3)] for v in range(4)}


def test_items_of_equal_texts_are_one_query(spark, monkeypatch):
    terms = [[(0, 1.0)], [(0, 0.6), (1, 0.8)], [(1, 1.0)], [(2, 1.0)]]
    rows = [(f"i{i:02}", s, w) for i in range(40) for s, w in terms[i % 4]]
    weights = spark.createDataFrame(rows, "item_id string, slot int, weight double")
    asked = []
    monkeypatch.setattr(recommending, "topk_inner_product", lambda q, *a, **o: asked.append(q.count()) or nearest.topk_inner_product(q, *a, **o))
    got = {(r["left_id"], r["rank"]): (r["right_id"], round(r["score"], 9)) for r in recommending.cosine_pairs(weights, 5).collect()}
    dense = np.zeros((40, 3))
    for i, s, w in rows:
        dense[int(i[1:]), s] = w
    made = np.round(dense @ dense.T, 9)
    np.fill_diagonal(made, -np.inf)
    order = np.argsort(-made, axis=1, kind="stable")[:, :5]
    assert got == {(f"i{i:02}", r + 1): (f"i{j:02}", made[i, j]) for i in range(40) for r, j in enumerate(order[i])}
    assert asked == [4]


def test_the_core_of_the_digest_embedding_gives_the_same_cosines(spark):
    texts = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "id long, text string")
    whole, core = (np.array([r["vector"] for r in retrieval.embed_text(texts, "text", m).orderBy(F.col("id")).collect()]) for m in ("digest", "digest_core"))
    assert core.shape == (20, 16) and np.allclose(whole @ whole.T, core @ core.T, rtol=0, atol=1e-12)


def asked_of(wave, docs, asked, k, min_score=None, exclude_same=False):
    """(ids, scores) of a search's rows beside brute force."""
    search = object.__new__(nearest._Search)
    search.k, search.digits, search.exclude_same, search.min_score, search.extent, search.scale = k, 6, exclude_same, min_score, False, None
    search.names, search.types = ["q", "d", "score"], [pa.int64(), pa.int64(), pa.float64()]
    kind = pa.struct([("dense", pa.list_(pa.float64())), ("slots", pa.list_(pa.int32())), ("weights", pa.list_(pa.float64()))])
    vectors = pa.array([{"dense": list(v), "slots": [], "weights": []} for v in asked], kind)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(asked)), pa.int64()), vectors], names=["q", "v"])
    got = pa.Table.from_batches(list(search.stream(wave, [batch]))).to_pylist()
    found = {(r["q"], r["d"], r["score"]) for r in got}
    made = np.round(asked @ docs.T, 6)
    if exclude_same:
        made[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    if min_score is not None:
        made[made < min_score] = -np.inf
    order = np.argsort(-made, axis=1, kind="stable")[:, :k]
    return found, {(q, int(i), made[q, i]) for q in range(len(asked)) for i in order[q] if np.isfinite(made[q, i])}


def unit(v):
    return v / np.sqrt((v * v).sum(axis=1))[:, None]


def test_a_query_meets_only_cells_whose_signs_it_shares():
    rng = np.random.default_rng(5)
    docs, asked = unit(rng.integers(-127, 128, (40_000, 10)) / 127.5), unit(rng.normal(size=(300, 10)))
    wave = nearest._Wave(np.arange(40_000), listed([(list(v), [], []) for v in docs]))
    for k, least in ((5, 0.1), (5, 0.8), (1, None)):
        wave.scored = 0
        got, due = asked_of(wave, docs, asked, k, least)
        assert got == due
        assert wave.scored < 0.5 * len(asked) * len(docs)


def test_cells_of_copies_zeros_and_one_sign(monkeypatch):
    monkeypatch.setattr(nearest, "FEWEST", 16)
    monkeypatch.setattr(nearest, "CHUNK", 64)
    monkeypatch.setattr(nearest, "PAIR_NUMBERS", 500)
    rng = np.random.default_rng(6)
    docs = unit(rng.integers(-2, 3, (3000, 5)) + 0.25)
    docs[rng.random(3000) < 0.4] = docs[0]  # copies tie, the lowest ids win
    docs[:40, 2], docs[40] = 0.0, 0.0
    docs[60:, 4] = np.abs(docs[60:, 4])
    wave = nearest._Wave(np.arange(3000), listed([(list(v), [], []) for v in docs]))
    for least in (None, 0.1, 0.95, 2.0):
        for same in (False, True):
            got, due = asked_of(wave, docs, docs[:200], 7, least, same)
            assert got == due
    positive = unit(rng.random((3000, 6)))
    wave = nearest._Wave(np.arange(3000), listed([(list(v), [], []) for v in positive]))
    got, due = asked_of(wave, positive, -positive[:50], 4)
    assert got == due


def test_documents_of_several_waves_are_read_by_piece(spark, monkeypatch):
    monkeypatch.setattr(nearest, "QUERY_BATCH_ROWS", 3)
    monkeypatch.setattr(nearest, "WAVE_BYTES", 4000)
    monkeypatch.setattr(nearest, "PIECE_BYTES", 2000)
    rng = np.random.default_rng(7)
    vectors = unit(rng.normal(size=(150, 4)))
    docs = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)] + [(999, None)], "id long, vector array<double>")
    asked = spark.createDataFrame([(f"q{i}", [float(x) for x in vectors[i]]) for i in range(20)] + [("q", None)], "query_id string, vector array<double>")
    got = {(r["query_id"], r["rank"], r["id"]) for r in nearest.topk_inner_product(asked, docs, 3, digits=6).collect()}
    made = np.round(vectors[:20] @ vectors.T, 6)
    order = np.argsort(-made, axis=1, kind="stable")[:, :3]
    assert got == {(f"q{i}", r + 1, int(d)) for i in range(20) for r, d in enumerate(order[i])}
    settled = nearest.settle(docs.where("vector is not null"))
    pieces = [piece for wave in nearest.waves(settled, "id", "vector") for piece in wave]
    assert len(pieces) == 4 and sorted(i for p in pieces for i in p["id"].to_pylist()) == list(range(150))


def test_documents_of_several_waves_do_not_pass_the_driver(spark, monkeypatch):
    monkeypatch.setattr(nearest, "QUERY_BATCH_ROWS", 3)
    monkeypatch.setattr(nearest, "WAVE_BYTES", 4000)
    monkeypatch.setattr(nearest, "PIECE_BYTES", 300)
    monkeypatch.setattr(nearest, "_streamed", None)  # ships documents by broadcast
    rng = np.random.default_rng(11)
    vectors = rng.normal(size=(300, 4))
    docs = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id long, vector array<double>")
    asked = spark.createDataFrame([(f"q{i}", [float(x) for x in vectors[i]]) for i in range(40)], "query_id string, vector array<double>")
    made = vectors[:40] @ vectors.T
    got = {(r["query_id"], r["rank"], r["id"]) for r in nearest.topk_inner_product(asked, docs, 3, digits=6).collect()}
    order = np.argsort(-np.round(made, 6), axis=1, kind="stable")[:, :3]
    assert got == {(f"q{i}", r + 1, int(d)) for i in range(40) for r, d in enumerate(order[i])}
    reach = {r["query_id"]: r for r in nearest.score_range(asked, docs, "query_id", "id").collect()}
    assert len(reach) == 40 and {r["n_items"] for r in reach.values()} == {300}
    for i in range(40):
        np.testing.assert_allclose([reach[f"q{i}"][c] for c in ("min_score", "max_score")], [made[i].min(), made[i].max()])


def test_texts_do_not_travel_for_embeddings(spark, tmp_path):
    spark.createDataFrame([(1, "Ab c", "en", "web")], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = retrieving.corpus(spark, str(tmp_path))
    plan = docs.select("id", "vector")._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" in plan.split("Join", 1)[-1]  # worked out below the join
    assert docs.columns == ["id", "title", "genre", "plot", "year", "rating", "director", "content", "vector"]
