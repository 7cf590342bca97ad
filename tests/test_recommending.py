import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tastegrid.operators import factors, nearest, recommending, retrieval, tfidf


@pytest.fixture(scope="module")
def ratings(spark):
    rng = np.random.default_rng(7)
    rows = [(f"u{u}", f"i{i}", float(rng.integers(1, 6))) for u in range(40) for i in range(25) if rng.random() < 0.4]
    return spark.createDataFrame(rows, "user_id string, item_id string, rating double").cache()


def dense(ratings):
    pdf = ratings.toPandas()
    return pdf.pivot_table(index="user_id", columns="item_id", values="rating", fill_value=0)


def test_svd_agrees_with_numpy(spark, ratings):
    m = dense(ratings)
    exact = np.linalg.svd(m.values, compute_uv=False)
    fitted = factors.fit_svd(ratings, n_components=6, iterations=12, oversample=8)
    assert np.allclose(fitted.singular_values, exact[:6], rtol=1e-3)
    u = {r["user_id"]: r["vector"] for r in fitted.user_factors.collect()}
    v = {r["item_id"]: r["vector"] for r in fitted.item_factors.collect()}
    approx = np.array([u[x] for x in m.index]) @ np.array([v[x] for x in m.columns]).T
    best = np.sqrt((exact[6:] ** 2).sum())
    assert np.linalg.norm(m.values - approx) <= best * 1.01
    mse = factors.train_mse(ratings, fitted.user_factors, fitted.item_factors).first()["train_mse"]
    assert np.isclose(mse, ((m.values - approx) ** 2).mean())


def test_shipped_and_joined_factors_agree(spark, monkeypatch, ratings):
    """Item factors that travel and item factors in tables: the same factors, users across many small batches."""
    odd = ratings.select("user_id", "item_id", "rating")
    odd = odd.unionAll(odd.limit(40)).unionAll(spark.createDataFrame([(None, 1, 5.0), (1, None, 5.0)], odd.schema))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        shipped = factors.fit_svd(odd, n_components=5, iterations=8)
        rows = [{r[0]: np.array(r[1]) for r in df.collect()} for df in (shipped.user_factors, shipped.item_factors)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    monkeypatch.setattr(factors, "FACTOR_BYTES", 0)
    joined = factors.fit_svd(odd, n_components=5, iterations=8)
    other = [{r[0]: np.array(r[1]) for r in df.collect()} for df in (joined.user_factors, joined.item_factors)]
    assert np.allclose(shipped.singular_values, joined.singular_values, rtol=1e-9)
    assert set(rows[0]) == set(other[0]) and set(rows[1]) == set(other[1])
    for u in rows[0]:
        for i in list(rows[1])[:10]:
            assert abs(rows[0][u] @ rows[1][i] - other[0][u] @ other[1][i]) < 1e-6


def test_factors_in_slabs_agree_with_numpy(spark, monkeypatch):
    """Blocks of several slabs on both sides."""
    monkeypatch.setattr(factors, "FACTOR_BYTES", 0)
    rng = np.random.default_rng(3)
    n_users, n_items, n = 9000, 6000, 60_000
    pairs = np.unique(np.column_stack([rng.integers(0, n_users, n), (n_items * rng.random(n) ** 3).astype(int)]), axis=0)
    value = rng.integers(1, 6, len(pairs)).astype(float)
    rows = spark.createDataFrame(pd.DataFrame({"user_id": pairs[:, 0], "item_id": pairs[:, 1], "rating": value}))
    fitted = factors.fit_svd(rows, n_components=6, iterations=4)
    u = {r[0]: r[1] for r in fitted.user_factors.collect()}
    v = {r[0]: r[1] for r in fitted.item_factors.collect()}
    assert set(u) == set(pairs[:, 0]) and set(v) == set(pairs[:, 1])
    left, right = (np.array([x[k] for k in sorted(x)]) for x in (u, v))
    place = [np.searchsorted(sorted(x), pairs[:, i]) for i, x in enumerate((u, v))]
    product = np.zeros(left.shape)
    np.add.at(product, place[0], value[:, None] * right[place[1]])
    assert np.allclose(right.T @ right, np.eye(6), atol=1e-8)  # V is orthonormal, and U·Σ = ratings x V
    assert np.allclose(product, left, atol=1e-8)
    assert np.allclose(np.sqrt((left**2).sum(axis=0)), fitted.singular_values)


def test_blocks_of_many_users_agree_with_the_columns(spark, monkeypatch):
    """A block of more than 32,768 users: the places of its slabs are beyond 16 bits."""
    monkeypatch.setattr(factors, "FACTOR_BYTES", 0)
    rows = spark.range(280_000).select(
        F.col("id").alias("user_id"), (F.col("id") % 3).alias("item_id"), (F.col("id") % 5 + 1).cast("double").alias("rating")
    )
    assert 280_000 / spark.sparkContext.defaultParallelism > 1 << 15
    found = factors.fit_svd(rows, n_components=2, iterations=1)
    # every user rates one item, so the singular values are the lengths of the items' columns
    squares = sorted((sum((i % 5 + 1) ** 2 for i in range(item, 280_000, 3)) for item in range(3)), reverse=True)
    np.testing.assert_allclose(found.singular_values, np.sqrt(squares[:2]), rtol=1e-9)


def test_error_in_blocks_is_that_of_the_join(spark, monkeypatch, ratings):
    """Repeated keys and ratings, nulls, and ratings without factors count as in the join."""
    rng = np.random.default_rng(5)

    def drawn(name, n):
        rows = [(f"{name[0]}{i % n}", [float(x) for x in rng.normal(size=3)]) for i in range(n + 2)]
        return spark.createDataFrame([*rows, (None, [1.0, 1.0, 1.0])], f"{name} string, vector array<double>")

    users, items = drawn("user_id", 35), drawn("item_id", 30)
    odd = ratings.unionAll(ratings.limit(30)).unionAll(spark.createDataFrame([(None, "i1", 5.0), ("u1", None, 5.0), ("u1", "i1", None)], ratings.schema))
    joined = factors.train_mse(odd, users, items, dims=3).first()[0]
    monkeypatch.setattr(factors, "FACTOR_BYTES", 0)
    assert np.isclose(factors.train_mse(odd, users, items, dims=3).first()[0], joined, rtol=1e-9)


def test_error_falls_with_more_components(spark, ratings):
    errors = []
    for k in (2, 8):
        f = factors.fit_svd(ratings, n_components=k, iterations=6)
        errors.append(factors.train_mse(ratings, f.user_factors, f.item_factors).first()["train_mse"])
    assert errors[1] < errors[0]


def test_sums_of_one_kind_are_those_of_both(spark):
    docs = spark.createDataFrame([(0, "red cat red cat"), (1, "cat"), (2, None), (3, "the")], "id long, text string")
    terms = tfidf.doc_terms(docs, "text")
    both = {r["term"]: (r["total"], r["df"]) for r in tfidf.term_sums(terms).collect()}
    assert {r["term"]: r["total"] for r in tfidf.term_totals(terms).collect()} == {t: n for t, (n, _) in both.items()}
    assert {r["term"]: r["df"] for r in tfidf.term_documents(terms).collect()} == {t: n for t, (_, n) in both.items()}
    assert both["red cat"] == (2, 1) and both["cat"] == (3, 2)


def vectors(spark, n, name, seed, dim=6):
    rng = np.random.default_rng(seed)
    # many equal vectors: ties must go to the lowest id
    rows = [(int(i), [float(x) for x in np.round(rng.normal(size=dim), 1)]) for i in range(n)]
    rows[1::3] = [(i, rows[0][1]) for i, _ in rows[1::3]]
    return spark.createDataFrame(rows, f"{name} long, vector array<double>")


def brute(q, d, k, same=False):
    out = {}
    docs = [(r["id"], np.array(r["vector"])) for r in d.collect()]
    for r in q.collect():
        scored = [(-round(float(np.dot(r["vector"], v)), 9), i) for i, v in docs if not (same and i == r["query_id"])]
        out[r["query_id"]] = [i for _, i in sorted(scored)[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["id"])
    return out


@pytest.mark.parametrize("shipped", [True, False])
@pytest.mark.parametrize("same", [False, True])
def test_both_search_plans_agree_with_brute_force(spark, monkeypatch, shipped, same):
    q, d = vectors(spark, 30, "query_id", 1), vectors(spark, 200, "id", 2)
    if not shipped:
        monkeypatch.setattr(nearest, "QUERY_BATCH_ROWS", 5)
        monkeypatch.setattr(nearest, "LEFT_BLOCK", 8)
        monkeypatch.setattr(nearest, "RIGHT_BLOCK", 32)
    assert found(nearest.topk_inner_product(q, d, 7, exclude_same=same)) == brute(q, d, 7, same)


@pytest.mark.parametrize("waves", [1, 3])
@pytest.mark.parametrize("same", [False, True])
def test_documents_in_waves_agree_with_brute_force(spark, monkeypatch, waves, same):
    q, d = vectors(spark, 30, "query_id", 1), vectors(spark, 200, "id", 2)
    monkeypatch.setattr(nearest, "QUERY_BATCH_ROWS", 5)
    monkeypatch.setattr(nearest, "CHUNK", 16)
    monkeypatch.setattr(nearest, "WAVE_BYTES", 200 * 8 * 8 // waves)
    monkeypatch.setattr(nearest, "block_pairs", None)
    assert found(nearest.topk_inner_product(q, d, 7, exclude_same=same)) == brute(q, d, 7, same)


def sparse_vectors(n, seed, negative):
    """Few heavy slots, many light ones; some rows are empty, equal, or share nothing."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        slots = sorted(set(np.minimum(rng.zipf(1.4, rng.integers(0, 9)), 300).tolist()))
        weights = [float(round(rng.normal() if negative else rng.random() / (1 + 3 * (s < 4)), 2)) for s in slots]
        rows.append((i, ([], slots, weights)))
    rows[5::11] = [(i, rows[4][1]) for i, _ in rows[5::11]]
    return rows


SPARSE = "long, vector struct<dense:array<double>,slots:array<int>,weights:array<double>>"


@pytest.mark.parametrize("negative", [False, True])
@pytest.mark.parametrize("same", [False, True])
@pytest.mark.parametrize("least, waves", [(None, 32), (0.5, 32), (None, 0)])
def test_sparse_search_agrees_with_brute_force(spark, monkeypatch, negative, same, least, waves):
    monkeypatch.setattr(nearest, "QUERY_BATCH_ROWS", 5)
    monkeypatch.setattr(nearest, "MOST_WAVES", waves)  # none: block by block
    monkeypatch.setattr(nearest, "RIGHT_BLOCK", 64)
    queries, docs = sparse_vectors(60, 1, negative), sparse_vectors(250, 2, negative)
    got = found(
        nearest.topk_inner_product(
            spark.createDataFrame(queries, f"query_id {SPARSE}"), spark.createDataFrame(docs, f"id {SPARSE}"), 6, exclude_same=same, min_score=least
        )
    )
    for q, (_, qs, qw) in queries:
        asked = dict(zip(qs, qw))
        scored = [(-round(sum(asked.get(s, 0.0) * w for s, w in zip(ds, dw)), 9), i) for i, (_, ds, dw) in docs if not (same and i == q)]
        assert got.get(q, []) == [i for v, i in sorted(scored)[:6] if least is None or -v >= least], q


def test_sparse_search_leaves_most_pairs_out():
    """Candidates are far fewer than pairs: lists of common slots are not read to the end of the query."""
    rng = np.random.default_rng(3)
    n, rows = 4000, []
    for _ in range(n):
        rare = rng.choice(np.arange(10, 2000), 4, replace=False).tolist()
        slots = [int(rng.integers(0, 5)), *map(int, rare)]
        w = np.array([0.1, 1, 1, 1, 1])
        rows.append(([], slots, (w / np.linalg.norm(w)).tolist()))
    column = nearest.pa.array([dict(zip(("dense", "slots", "weights"), r)) for r in rows], nearest.pa.struct(
        [("dense", nearest.pa.list_(nearest.pa.float64())), ("slots", nearest.pa.list_(nearest.pa.int32())), ("weights", nearest.pa.list_(nearest.pa.float64()))]
    ))
    vectors_ = nearest._Vectors(column)
    wave, sums = nearest._Wave(np.arange(n), vectors_), np.zeros(n)

    class Asked:
        k, digits, exclude_same, min_score, allowed = 5, 9, True, None, nearest._Search.allowed

    for i, (entries, weights) in enumerate(wave.tails(vectors_)):
        wave.sparse_best(entries, weights, Asked(), i, sums)
    assert wave.scored < n * n / 50
    assert not sums.any() and not wave.seen.any()


def test_hot_cell_is_split_and_stays_exact(spark, monkeypatch):
    monkeypatch.setattr(nearest, "LEFT_BLOCK", 4)
    monkeypatch.setattr(nearest, "RIGHT_BLOCK", 16)
    q, d = vectors(spark, 12, "query_id", 3), vectors(spark, 150, "id", 4)
    one_cell = nearest.topk_in_cells(q.withColumn("centroid", F.lit(0)), d.withColumn("centroid", F.lit(0)), 5)
    assert found(one_cell) == brute(q, d, 5)


def test_all_cells_probed_is_exact(spark):
    d = vectors(spark, 120, "id", 5)
    q = vectors(spark, 10, "query_id", 6)
    indexed, centers = retrieval.ivf_build(d, cells=4)
    unit = indexed.select("id", "vector")
    assert found(retrieval.ivf_search(q, indexed, centers, 5, nprobe=4)) == brute(q, unit, 5)
    assert indexed.count() == 120


def test_similar_items_through_cells(spark):
    d = retrieval.ivf_build(vectors(spark, 90, "id", 8), cells=3)
    exact = retrieval.similar_items(d[0], 4).withColumnRenamed("id", "query_id").withColumnRenamed("similar_id", "id")
    probed = retrieval.similar_items(d[0], 4, index=d, nprobe=3).withColumnRenamed("id", "query_id").withColumnRenamed("similar_id", "id")
    assert found(exact) == found(probed)


def test_cell_count():
    assert [retrieval.cell_count(n) for n in (10, 10_000, 10_100, 1_000_000)] == [1, 1, 100, 100]


def test_hybrid_scores_stay_in_range(spark, ratings):
    f = factors.fit_svd(ratings, n_components=4, iterations=4)
    items = ratings.select(F.col("item_id").alias("id")).distinct().select(
        "id", F.concat(F.lit("film "), F.col("id")).alias("title"), F.lit("Action|Drama").alias("genre"), F.lit("a long way").alias("plot")
    )
    history = recommending.topn_history(ratings)
    top = recommending.hybrid_recommend(f.user_factors, f.item_factors, history, recommending.item_weights(items), 3)
    rows = top.collect()
    assert all(-1e-9 <= r["score"] <= 1 + 1e-9 for r in rows)
    assert len(rows) == 3 * 40
    cold = spark.createDataFrame([("nobody",)], "user_id string")
    warm = recommending.recs_with_metadata(top, items)
    both = recommending.warm_cold_union(warm, cold, recommending.popular_items(items, 3, order="id"))
    assert both.where("user_id = 'nobody'").count() == 3
    assert {r["score"] for r in both.where("user_id = 'nobody'").collect()} == {0.5}


def test_hybrid_in_one_wave_and_in_many(spark, monkeypatch, ratings):
    f = factors.fit_svd(ratings, n_components=4, iterations=4)
    titles = F.concat(F.lit("film "), F.when(F.hash("id") % 2 == 0, "night").otherwise("day"), F.lit(" "), F.col("id"))
    items = ratings.select(F.col("item_id").alias("id")).distinct().select("id", titles.alias("title"), F.lit("Action|Drama").alias("genre"), F.lit("way").alias("plot"))
    weights, history = recommending.item_weights(items), recommending.topn_history(ratings)
    some = items.where("hash(id) % 3 != 0").select(F.col("id").alias("item_id"))

    def rows():
        top = recommending.hybrid_recommend(f.user_factors, f.item_factors, history, weights, 3, candidates=some)
        return {(r["user_id"], r["rank"], r["item_id"]): r["score"] for r in top.collect()}

    whole = rows()
    monkeypatch.setattr(nearest, "WAVE_BYTES", 1000)
    parts = rows()
    assert parts.keys() == whole.keys() and len(whole) == 120
    assert all(abs(parts[key] - whole[key]) < 1e-8 for key in whole)


def test_keyword_points(spark):
    items = spark.createDataFrame(
        [(1, "Avatar", "Action|Sci-Fi", "James Cameron", "marine on alien planet"), (2, "Titanic", "Drama", "", "a ship"), (3, "Up", "", "X Y", "house")],
        "id long, title string, genre string, director string, plot string",
    )
    q = spark.createDataFrame([("a", "is avatar an action film by james cameron on an alien planet")], "query_id string, query string")
    rows = {r["id"]: r["score"] for r in retrieval.keyword_context_join(q, items).collect()}
    # empty director and empty genre are substrings of every query
    assert rows == {1: 3 + 2 + 2 + 0.5 + 0.5, 2: 2.0, 3: 2.0}


@pytest.mark.parametrize("small", [False, True])
def test_keyword_points_agree_with_brute_force(spark, monkeypatch, small):
    """Nulls, equal rows, empty names and texts; also with a dictionary in many parts and items in many waves."""
    rng = np.random.default_rng(4)
    words = ["night", "alien", "of", "planet", "sea", "marine", "Über", "ship", "lie", "ali"]

    def text(n):
        return " ".join(rng.choice(words, n)) if n else (None if rng.random() < 0.5 else "")

    items = [
        (i, text(rng.integers(0, 3)), "|".join(rng.choice(words, rng.integers(0, 3))), text(rng.integers(0, 2)), text(rng.integers(0, 12)))
        for i in range(120)
    ]
    queries = [(f"q{i}", text(rng.integers(0, 9))) for i in range(40)]
    if small:
        monkeypatch.setattr(retrieval, "DICTIONARY_BYTES", 60)
        monkeypatch.setattr(nearest, "WAVE_BYTES", 3000)
    got = retrieval.keyword_context_join(
        spark.createDataFrame(queries, "query_id string, query string"),
        spark.createDataFrame(items, "id long, title string, genre string, director string, plot string"), 4,
    ).collect()
    want = []
    for qid, query in queries:
        query, scored = (query or "").lower(), []
        for i, title, genre, director, plot in items:
            title, director, plot = ((v or "").lower() for v in (title, director, plot))
            points = 3.0 * (title in query) + 2.0 * (director in query) + sum(2.0 for g in genre.lower().split("|") if g in query)
            scored.append((-points - sum(0.5 for w in query.split() if len(w) >= 4 and w in plot), i))
        want += [(qid, i, -v, r) for r, (v, i) in enumerate(sorted(scored)[:4], 1) if v < 0]
    assert sorted((r["query_id"], r["id"], r["score"], r["rank"]) for r in got) == sorted(want)


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("same", [False, True])
def test_sparse_queries_travel_to_the_documents(spark, monkeypatch, small, same):
    """The documents are not collected; ties, repeated ids and documents in many portions."""
    if small:
        monkeypatch.setattr(nearest, "LIST_NUMBERS", 40)
        monkeypatch.setattr(nearest, "WAVE_BYTES", 3000)
    rng = np.random.default_rng(8)

    def sparse(n):
        slots = [sorted(map(int, rng.choice(30, rng.integers(0, 8), replace=False))) for _ in range(n)]
        return [(i - i % 50 // 49, ([], s, [float(x) for x in rng.integers(-1, 4, len(s)) / 2])) for i, s in enumerate(slots)]

    queries, docs = sparse(70), sparse(300)
    kind = "vector struct<dense: array<double>, slots: array<int>, weights: array<double>>"
    q, d = spark.createDataFrame(queries, f"query_id long, {kind}"), spark.createDataFrame(docs, f"id long, {kind}").repartition(3)
    sent, waves = [], nearest.waves
    monkeypatch.setattr(nearest, "waves", lambda df, key, vector: sent.append(key) or waves(df, key, vector))
    want = []
    if not same:
        for qid, (_, qs, qw) in queries:
            asked = dict(zip(qs, qw))
            want.append((qid, sorted((-sum(asked.get(s, 0.0) * w for s, w in zip(ds, dw)), i) for i, (_, ds, dw) in docs)))
        # ids come twice: the rows of both queries compete
        want = sorted((qid, i, -v) for qid in {x for x, _ in queries} for v, i in sorted(y for x, r in want if x == qid for y in r)[:4] if v <= -0.5)
        got = nearest.topk_inner_product(q, d, 4, min_score=0.5, route="queries").collect()
    else:
        want = sorted(tuple(r)[:3] for r in nearest.topk_inner_product(q, d, 4, exclude_same=True, min_score=0.5, route="pair").collect())
        sent.clear()
        got = nearest.topk_inner_product(q, d, 4, exclude_same=True, min_score=0.5, route="queries").collect()
    assert sorted(tuple(r)[:3] for r in got) == want and len(want) > 150
    assert sent == ["query_id"]


@pytest.mark.parametrize("twice", [False, True])
def test_hashed_vectors_shuffle_terms_without_counting_again(spark, twice):
    """Terms are counted where the text is; rows of one id are one document; empty and null texts have no rows."""
    texts = ["The blue SEA, the sea! Über a x", "", None, "sea sky", "the of and", "Über_1 sky sky " * 50]
    rows = [(i, t) for i, t in enumerate(texts)] + ([(3, "sky new"), (None, "sea"), (None, "sky")] if twice else [])
    docs = spark.createDataFrame(rows, "id long, text string").repartition(3)
    bags = defaultdict(Counter)
    for i, t in rows:
        bags[i].update(w for w in re.split(r"\W+", (t or "").lower()) if len(w) >= 2 and w not in tfidf.STOP_WORDS)
    df = Counter(w for bag in bags.values() for w in bag)
    want = defaultdict(float)
    for i, bag in bags.items():
        for w, n in bag.items():
            want[i, int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 384] += n * (np.log((1 + len(rows)) / (1 + df[w])) + 1)
    norm = {i: sum(w * w for (j, _), w in want.items() if j == i) ** 0.5 for i in bags}
    got = tfidf.hashed_vectors(docs, "text")
    found = {(r["id"], r["bucket"]): r["weight"] for r in got.collect()}
    assert found.keys() == want.keys() and all(abs(found[key] - w / norm[key[0]]) < 1e-12 for key, w in want.items())
    if not twice:
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(id" in plan and not re.search(r"hashpartitioning\(id#\d+L?, (term|bucket)", plan)


def test_unknown_embedding_model(spark):
    with pytest.raises(ValueError):
        retrieval.embed_text(spark.range(1), "id", "no_such_model")


def test_null_vectors_and_int_ids(spark):
    rows = [(i, None if i % 3 == 0 else [float(i), 1.0]) for i in range(12)]
    d = spark.createDataFrame(rows, "id int, vector array<double>")
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "query_id smallint, vector array<double>")
    for route in ("checked", "pair"):
        hits = nearest.topk_inner_product(q, d, 3, route=route).orderBy("rank").collect()
        assert [(r["query_id"], r["id"]) for r in hits] == [(1, 11), (1, 10), (1, 8)]
    extent = nearest.score_range(q, d, "query_id", "id").collect()
    assert [(r["query_id"], r["min_score"], r["max_score"], r["n_items"]) for r in extent] == [(1, 1.0, 11.0, 8)]


def test_unequal_lengths_are_refused_by_name(spark):
    d = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0])], "id long, vector array<double>").coalesce(1)
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, vector array<double>")
    with pytest.raises(Exception, match="different lengths"):
        nearest.topk_inner_product(q, d, 3).collect()


def test_cell_search_reads_probed_folders_only(spark, tmp_path):
    from tastegrid.sources import stores

    rng = np.random.default_rng(5)
    v = rng.normal(size=(400, 8))
    v /= np.linalg.norm(v, axis=1)[:, None]
    docs = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id long, vector array<double>")
    stores.save_index(*retrieval.ivf_build(docs, cells=8), str(tmp_path / "i"))
    indexed, centers = stores.load_index(spark, str(tmp_path / "i"))
    q = docs.limit(1).withColumnRenamed("id", "query_id")
    found = retrieval.ivf_search(q, indexed, centers, 5, nprobe=2)
    plan = found._jdf.queryExecution().toString()
    assert any("PartitionFilters" in line and "centroid" in line and " IN " in line for line in plan.splitlines())
    assert found.first()["id"] == q.first()["query_id"]
    queries = docs.withColumnRenamed("id", "query_id")
    exact = nearest.topk_inner_product(queries, docs, 5)
    recalls = [retrieval.recall_at_k(retrieval.ivf_search(queries, indexed, centers, 5, nprobe=n), exact).first()["recall"] for n in (1, 4, 8)]
    assert recalls[0] <= recalls[1] and recalls[1] >= 0.9 and recalls[2] == 1.0


def test_an_index_is_flat_unless_the_caller_says_otherwise(spark):
    docs = spark.range(10).select("id", F.array(F.col("id").cast("double"), F.lit(1.0)).alias("vector"))
    indexed, centers = retrieval.ivf_build(docs)
    assert indexed.select("centroid").distinct().count() == 1 and centers.count() == 0


def test_tfidf_inside_the_row(spark):
    import math
    from collections import Counter

    from tastegrid.operators import tfidf

    texts = {1: "red fox red", 2: None, 3: "", 4: "the of", 5: "blue fox", 6: "red"}
    docs = spark.createDataFrame(list(texts.items()), "id int, text string")
    got = {(r["id"], r["term"]): r["weight"] for r in tfidf.fit_tfidf(docs, "text", max_features=4).collect()}
    terms = {}
    for i, t in texts.items():
        words = [w for w in (t or "").split() if w not in tfidf.STOP_WORDS]
        terms[i] = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    total, df = Counter(t for v in terms.values() for t in v), Counter(t for v in terms.values() for t in set(v))
    kept = sorted(total, key=lambda t: (-total[t], t))[:4]
    for i, v in terms.items():
        raw = {t: v.count(t) * (math.log(7 / (1 + df[t])) + 1) for t in kept if t in v}
        size = math.sqrt(sum(w * w for w in raw.values()))
        for t, w in raw.items():
            assert got.pop((i, t)) == pytest.approx(w / size)
    assert not got
    assert tfidf.fit_tfidf(docs.limit(0), "text").count() == 0
