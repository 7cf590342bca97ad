"""Cleaning, sampling, matrix and recommendation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.functions.hashing import digest_vector
from tastegrid.functions.text import split_genres
from tastegrid.operators import cleaning, factors, recommending, tfidf
from tastegrid.plans.registry import ITEMS, RATINGS, query
from tastegrid.sources import tables
from tastegrid.sources.tables import table

ORDER = ["ts", "o_key", "line", "rating"]
FACTOR_DIM = 16


def clean(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.clean_ratings(tables.raw_ratings(spark, d), ORDER)


def digest_sql(expr: str, dim: int = FACTOR_DIM) -> str:
    return (
        f"list_transform(range(0, {dim}), lambda i: CAST(('0x' || substr(md5(lower({expr})), "
        f"CAST(2 * (i % 16) + 1 AS BIGINT), 2)) AS BIGINT) / 127.5 - 1.0)"
    )


def hash_factors(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Factors given by a hash of the id: every rated user and every item, comparable with SQL."""
    users = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("user_id")).distinct()
    items = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("item_id"))
    return (
        users.select("user_id", digest_vector(F.col("user_id"), FACTOR_DIM).alias("vector")),
        items.select("item_id", digest_vector(F.col("item_id"), FACTOR_DIM).alias("vector")),
    )


FACTORS = f"""uf AS (
  SELECT user_id, {digest_sql('user_id')} AS v FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS user_id FROM orders)),
vf AS (SELECT CAST(p_partkey AS VARCHAR) AS item_id, {digest_sql('CAST(p_partkey AS VARCHAR)')} AS v FROM part),
collab AS (SELECT user_id, item_id, raw, round(raw, 9) AS s
  FROM (SELECT user_id, item_id, list_dot_product(uf.v, vf.v) AS raw FROM uf, vf))"""
HISTORY = """history AS (
  SELECT user_id, item_id, rating, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rank FROM ratings)
  WHERE rank <= 5)"""


@query(
    "clean_items",
    f"WITH {ITEMS} SELECT id, title, genre, year, rating FROM items WHERE id IS NOT NULL AND title IS NOT NULL",
)
def _(spark, d):
    # every item twice: the copy must go
    both = tables.items(spark, d).unionByName(tables.items(spark, d).withColumn("position", F.col("position") + 1_000_000_000))
    return cleaning.clean_items(both, ["position"]).select("id", "title", "genre", "year", "rating")


@query("clean_ratings", f"WITH {RATINGS} SELECT user_id, item_id, rating, ts FROM ratings")
def _(spark, d):
    return clean(spark, d).select("user_id", "item_id", "rating", "ts")


@query(
    "sample_users",
    f"""WITH {RATINGS}, picked AS (
  SELECT user_id FROM (SELECT DISTINCT user_id FROM ratings) ORDER BY md5('42:' || user_id), user_id LIMIT 100)
SELECT CAST(count(*) AS BIGINT) AS n_ratings, CAST(count(DISTINCT user_id) AS BIGINT) AS n_users,
       CAST(count(DISTINCT item_id) AS BIGINT) AS n_items, sum(rating) AS total
FROM ratings WHERE user_id IN (SELECT user_id FROM picked)""",
)
def _(spark, d):
    _, kept = cleaning.sample_users(tables.items(spark, d), clean(spark, d), 100)
    return kept.agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.count_distinct("user_id").alias("n_users"),
        F.count_distinct("item_id").alias("n_items"),
        F.sum("rating").alias("total"),
    )


@query(
    "semi_rated_items",
    f"WITH {RATINGS}, {ITEMS} SELECT id, title FROM items WHERE id IN (SELECT item_id FROM ratings WHERE rating >= 5)",
)
def _(spark, d):
    best = clean(spark, d).where("rating >= 5")
    return cleaning.semi_rated_items(tables.items(spark, d), best).select("id", "title")


@query(
    "semi_sampled_users",
    f"""WITH {RATINGS} SELECT user_id, item_id, rating FROM ratings WHERE user_id IN (
  SELECT user_id FROM (SELECT DISTINCT user_id FROM ratings) ORDER BY md5('42:' || user_id), user_id LIMIT 200)""",
)
def _(spark, d):
    rated = clean(spark, d)
    return cleaning.semi_sampled_users(rated, cleaning.pick_users(rated, 200)).select("user_id", "item_id", "rating")


@query("distinct_users", "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS user_id FROM orders")
def _(spark, d):
    return cleaning.distinct_users(table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("user_id")))


@query("distinct_items", "SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS item_id FROM lineitem")
def _(spark, d):
    return cleaning.distinct_items(table(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("item_id")))


@query(
    "user_item_ratings",
    f"WITH {RATINGS} SELECT user_id, item_id, round(avg(rating), 6) AS rating FROM raw_ratings GROUP BY user_id, item_id",
)
def _(spark, d):
    mean = recommending.user_item_ratings(tables.raw_ratings(spark, d))
    return mean.select("user_id", "item_id", F.round("rating", 6).alias("rating"))


@query(
    "user_item_pivot",
    """WITH r AS (SELECT c.c_mktsegment AS item_id, CAST(o_custkey AS VARCHAR) AS user_id, ceil(l_quantity / 10) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer c ON c_custkey = o_custkey)
SELECT user_id, round(coalesce(avg(CASE WHEN item_id = 'BUILDING' THEN rating END), 0.0), 6) AS building,
  round(coalesce(avg(CASE WHEN item_id = 'MACHINERY' THEN rating END), 0.0), 6) AS machinery FROM r GROUP BY user_id""",
)
def _(spark, d):
    segments = table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("user_id"), F.col("c_mktsegment").alias("segment")
    )
    rated = tables.raw_ratings(spark, d).join(segments, "user_id").select("user_id", F.col("segment").alias("item_id"), "rating")
    wide = recommending.user_item_pivot(rated, ["BUILDING", "MACHINERY"])
    return wide.select(
        "user_id", F.round("BUILDING", 6).alias("building"), F.round("MACHINERY", 6).alias("machinery")
    )


@query(
    "matrix_shape",
    f"""WITH {RATINGS} SELECT CAST(count(DISTINCT user_id) AS BIGINT) AS n_users,
  CAST(count(DISTINCT item_id) AS BIGINT) AS n_items, CAST(count(*) AS BIGINT) AS n_rated,
  round(count(*) / (CAST(count(DISTINCT user_id) AS DOUBLE) * count(DISTINCT item_id)), 9) AS density FROM ratings""",
)
def _(spark, d):
    return recommending.matrix_shape(clean(spark, d)).withColumn("density", F.round("density", 9))


@query(
    "train_test_split_users",
    """SELECT user_id, (CAST('0x' || substr(md5('42:' || user_id), 1, 8) AS BIGINT) % 10000) < 2000 AS is_test
FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS user_id FROM orders)""",
)
def _(spark, d):
    users = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("user_id")).distinct()
    return cleaning.train_test_split_users(users)


@query("fit_svd")
def _(spark, d):
    """Singular values of the training users' matrix, largest first."""
    rated = cleaning.train_test_split_users(clean(spark, d)).where("not is_test")
    fitted = factors.fit_svd(rated)
    values = [(i + 1, round(v, 6)) for i, v in enumerate(fitted.singular_values)]
    return spark.createDataFrame(values, "component int, singular_value double")


@query(
    "train_mse",
    f"""WITH {RATINGS}, {FACTORS}
SELECT round(avg((coalesce(r.rating, 0) - raw) * (coalesce(r.rating, 0) - raw)), 5) AS train_mse
FROM collab c LEFT JOIN ratings r ON c.user_id = r.user_id AND c.item_id = r.item_id""",
)
def _(spark, d):
    users, items = hash_factors(spark, d)
    mse = factors.train_mse(clean(spark, d), users, items, dims=FACTOR_DIM)
    return mse.select(F.round("train_mse", 5).alias("train_mse"))


@query(
    "score_collab",
    f"""WITH {FACTORS} SELECT user_id, item_id, round(s, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s DESC, item_id) AS rank FROM collab) WHERE rank <= 10""",
)
def _(spark, d):
    return recommending.score_collab(*hash_factors(spark, d)).withColumn("score", F.round("score", 6))


@query(
    "minmax_per_user",
    f"""WITH {FACTORS} SELECT user_id, round(min(s), 6) AS min_score, round(max(s), 6) AS max_score,
  CAST(count(*) AS BIGINT) AS n_items FROM collab GROUP BY user_id""",
)
def _(spark, d):
    extent = recommending.minmax_per_user(*hash_factors(spark, d))
    return extent.withColumn("min_score", F.round("min_score", 6)).withColumn("max_score", F.round("max_score", 6))


@query(
    "topk_per_user",
    f"""WITH {FACTORS}, scaled AS (
  SELECT user_id, item_id, s, (s - min(s) OVER u) / (max(s) OVER u - min(s) OVER u + 1e-10) AS score,
         row_number() OVER (PARTITION BY user_id ORDER BY s DESC, item_id) AS rank
  FROM collab WINDOW u AS (PARTITION BY user_id))
SELECT user_id, item_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM scaled WHERE rank <= 10""",
)
def _(spark, d):
    return recommending.topk_per_user(*hash_factors(spark, d)).withColumn("score", F.round("score", 6))


@query(
    "topn_history",
    f"WITH {RATINGS}, {HISTORY} SELECT user_id, item_id, rating, CAST(rank AS INTEGER) AS rank FROM history",
)
def _(spark, d):
    return recommending.topn_history(clean(spark, d)).select("user_id", "item_id", "rating", "rank")


@query(
    "history_profile",
    f"""WITH {RATINGS}, {ITEMS}, {HISTORY}, parts AS (
  SELECT user_id, trim(unnest(string_split(genre, '|'))) AS g FROM history JOIN items ON item_id = id),
g AS (SELECT user_id, list_sort(list(DISTINCT g)) AS gs FROM parts GROUP BY user_id),
dr AS (SELECT user_id, list_sort(list(DISTINCT director)) AS ds FROM history JOIN items ON item_id = id GROUP BY user_id)
SELECT user_id, array_to_string(gs, ',') AS genres, array_to_string(ds, ',') AS directors,
       array_to_string(gs[1:3], ', ') AS liked FROM g JOIN dr USING (user_id)""",
)
def _(spark, d):
    profile = recommending.history_profile(recommending.topn_history(clean(spark, d)), tables.items(spark, d))
    return profile.select(
        "user_id", F.array_join("genres", ",").alias("genres"), F.array_join("directors", ",").alias("directors"), "liked"
    )


# ---- content: TF-IDF over the items ----
_STOP = ", ".join(f"'{w}'" for w in tfidf.STOP_WORDS)

def tf_sql(source: str, id_col: str, text: str) -> str:
    return f"""toks AS (SELECT {id_col}, list_filter(string_split_regex(lower({text}), '[^\\p{{L}}\\p{{N}}_]+'),
    lambda t: length(t) >= 2 AND NOT list_contains([{_STOP}], t)) AS t FROM {source}),
grams AS (SELECT {id_col}, unnest(t) AS term FROM toks
  UNION ALL SELECT {id_col}, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM toks WHERE len(t) > 1),
tf AS (SELECT {id_col}, term, CAST(count(*) AS BIGINT) AS tf FROM grams GROUP BY ALL)"""


def tfidf_sql(source: str, id_col: str, text: str) -> str:
    return f"""{tf_sql(source, id_col, text)},
vocab AS (SELECT term, ln((1.0 + (SELECT count(*) FROM {source})) / (1.0 + count(*))) + 1.0 AS idf, sum(tf) AS total
  FROM tf GROUP BY term ORDER BY total DESC, term LIMIT 1000),
w AS (SELECT {id_col}, term, tf * idf AS w FROM tf JOIN vocab USING (term)),
weights AS (SELECT {id_col}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {id_col})) AS weight FROM w)"""


ITEM_TEXT = "itext AS (SELECT id AS item_id, genre || ' ' || plot || ' ' || title AS content FROM items)"


def item_text(spark: SparkSession, d: str) -> DataFrame:
    return tables.items(spark, d).select(
        F.col("id").alias("item_id"),
        tfidf.item_content(F.col("genre"), F.col("plot"), F.col("title")).alias("content"),
    )


@query(
    "fit_tfidf",
    f"""WITH {ITEMS}, {ITEM_TEXT}, {tfidf_sql('itext', 'item_id', 'content')}
SELECT item_id, term, round(weight, 6) AS weight FROM weights""",
)
def _(spark, d):
    fitted = tfidf.fit_tfidf(item_text(spark, d), "content", "item_id")
    return fitted.withColumn("weight", F.round("weight", 6))


@query(
    "vocabulary_topn",
    f"""WITH {tf_sql('documents', 'doc_id', 'text')}
SELECT term, CAST(sum(tf) AS BIGINT) AS total FROM tf GROUP BY term ORDER BY total DESC, term LIMIT 1000""",
)
def _(spark, d):
    return tfidf.vocabulary_topn(tfidf.term_totals(tfidf.doc_terms(tables.texts(spark, d, "documents", "doc_id"), "text", "doc_id")))


@query(
    "doc_frequency",
    f"""WITH {tf_sql('documents', 'doc_id', 'text')}
SELECT term, CAST(count(*) AS BIGINT) AS df,
  round(ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + count(*))) + 1.0, 6) AS idf FROM tf GROUP BY term""",
)
def _(spark, d):
    docs = tables.texts(spark, d, "documents", "doc_id")
    freq = tfidf.doc_frequency(tfidf.term_documents(tfidf.doc_terms(docs, "text", "doc_id")), docs.count())
    return freq.withColumn("idf", F.round("idf", 6))


@query(
    "cosine_pairs",
    f"""WITH {ITEMS}, {ITEM_TEXT}, {tfidf_sql('itext', 'item_id', 'content')},
sim AS (SELECT a.item_id AS left_id, b.item_id AS right_id, round(sum(a.weight * b.weight), 6) AS score
  FROM weights a JOIN weights b ON a.term = b.term WHERE a.item_id <> b.item_id GROUP BY ALL)
SELECT left_id, right_id, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY left_id ORDER BY score DESC, right_id) AS rank FROM sim) WHERE rank <= 5""",
)
def _(spark, d):
    return recommending.cosine_pairs(recommending.item_weights(tables.items(spark, d)), 5, digits=6)


_CONTENT = """profile AS (SELECT user_id, term, sum(weight) / any_value(n) AS weight
  FROM history JOIN (SELECT user_id, count(*) AS n FROM history GROUP BY user_id) USING (user_id)
  JOIN weights USING (item_id) GROUP BY user_id, term),
content AS (SELECT user_id, w.item_id, sum(p.weight * w.weight) AS c
  FROM profile p JOIN weights w ON p.term = w.term GROUP BY ALL)"""


@query(
    "score_content",
    f"""WITH {RATINGS}, {ITEMS}, {HISTORY}, {ITEM_TEXT}, {tfidf_sql('itext', 'item_id', 'content')}, {_CONTENT}
SELECT user_id, item_id, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank
  FROM (SELECT user_id, item_id, round(c, 6) AS score FROM content)) WHERE rank <= 10""",
)
def _(spark, d):
    weights = recommending.item_weights(tables.items(spark, d))
    return recommending.score_content(recommending.topn_history(clean(spark, d)), weights, 10, digits=6)


_HYBRID = f"""WITH {RATINGS}, {ITEMS}, {HISTORY}, {ITEM_TEXT}, {tfidf_sql('itext', 'item_id', 'content')}, {_CONTENT}, {FACTORS},
scaled AS (SELECT user_id, item_id, (raw - min(raw) OVER u) / (max(raw) OVER u - min(raw) OVER u + 1e-10) AS s
  FROM collab WINDOW u AS (PARTITION BY user_id)),
hybrid AS (SELECT user_id, item_id, 0.7 * s + 0.3 * coalesce(c, 0) AS score
  FROM scaled LEFT JOIN content USING (user_id, item_id))"""


@query(
    "hybrid_recommend",
    f"""{_HYBRID} SELECT user_id, item_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM hybrid) WHERE rank <= 10""",
)
def _(spark, d):
    return hybrid(spark, d)


@query(
    "candidate_restrict",
    f"""{_HYBRID} SELECT user_id, item_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM hybrid
  WHERE item_id IN (SELECT id FROM items WHERE year >= 2010)) WHERE rank <= 5""",
)
def _(spark, d):
    recent = tables.items(spark, d).where("year >= 2010").select(F.col("id").alias("item_id"))
    return hybrid(spark, d, 5, recent)


def hybrid(spark: SparkSession, d: str, k: int = 10, candidates: DataFrame | None = None) -> DataFrame:
    users, items = hash_factors(spark, d)
    weights = recommending.item_weights(tables.items(spark, d))
    history = recommending.topn_history(clean(spark, d))
    top = recommending.hybrid_recommend(users, items, history, weights, k, candidates=candidates, digits=12)
    return top.withColumn("score", F.round("score", 6))


@query(
    "recs_with_metadata",
    f"""WITH {ITEMS}, {FACTORS}, top AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s DESC, item_id) AS rank FROM collab QUALIFY rank <= 10)
SELECT user_id, item_id, title, replace(genre, '|', ',') AS genres, CAST(rank AS INTEGER) AS rank
FROM top JOIN items ON item_id = id WHERE year >= 2000""",
)
def _(spark, d):
    # items before 2000 are not in the catalogue: their ids drop out after ranking
    top = recommending.score_collab(*hash_factors(spark, d))
    kept = recommending.recs_with_metadata(top, tables.items(spark, d).where("year >= 2000"))
    return kept.select("user_id", "item_id", "title", F.array_join("genres", ",").alias("genres"), "rank")


@query(
    "known_vs_cold_users",
    """SELECT CAST(c_custkey AS VARCHAR) AS user_id,
  CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 300000)
       THEN 'known' ELSE 'cold' END AS kind FROM customer""",
)
def _(spark, d):
    users = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("user_id"))
    seen = table(spark, d, "orders").where("o_orderstatus = 'P' and o_totalprice > 300000")
    known, cold = recommending.known_vs_cold_users(users, seen.select(F.col("o_custkey").cast("string").alias("user_id")))
    return known.withColumn("kind", F.lit("known")).unionByName(cold.withColumn("kind", F.lit("cold")))


@query(
    "warm_cold_union",
    f"""WITH {ITEMS}, {FACTORS}, seen AS (
  SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS user_id FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 300000),
top AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s DESC, item_id) AS rank FROM collab QUALIFY rank <= 3)
SELECT user_id, item_id, title, round(s, 6) AS score, CAST(rank AS INTEGER) AS rank
FROM top JOIN items ON item_id = id WHERE user_id IN (SELECT user_id FROM seen)
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), id, title, 0.5, CAST(n AS INTEGER)
FROM customer, (SELECT id, title, row_number() OVER (ORDER BY position) AS n FROM items QUALIFY n <= 3)
WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT user_id FROM seen)""",
)
def _(spark, d):
    users = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("user_id"))
    seen = table(spark, d, "orders").where("o_orderstatus = 'P' and o_totalprice > 300000")
    known, cold = recommending.known_vs_cold_users(users, seen.select(F.col("o_custkey").cast("string").alias("user_id")))
    uf, vf = hash_factors(spark, d)
    items = tables.items(spark, d)
    warm = recommending.recs_with_metadata(recommending.score_collab(uf.join(known, "user_id", "left_semi"), vf, 3), items)
    rows = recommending.warm_cold_union(warm, cold, recommending.popular_items(items, 3))
    return rows.select("user_id", "item_id", "title", F.round("score", 6).alias("score"), "rank")


@query(
    "popular_items",
    f"WITH {ITEMS} SELECT id AS item_id, title, 0.5 AS score, replace(genre, '|', ',') AS genres FROM items ORDER BY position LIMIT 10",
)
def _(spark, d):
    return recommending.popular_items(tables.items(spark, d), 10).withColumn("genres", F.array_join("genres", ","))


@query(
    "popular_by_rating_count",
    f"""WITH {RATINGS}, {ITEMS} SELECT id AS item_id, title FROM items
  JOIN (SELECT item_id, count(*) AS n FROM ratings GROUP BY item_id) ON item_id = id ORDER BY n DESC, id LIMIT 10""",
)
def _(spark, d):
    top = recommending.popular_items(tables.items(spark, d), 10, ratings=clean(spark, d))
    return top.select("item_id", "title")


@query(
    "top_rated_items",
    f"""WITH {ITEMS} SELECT id AS item_id, title, round(rating / 5.0, 6) AS score, replace(genre, '|', ',') AS genres
FROM items ORDER BY rating DESC, id LIMIT 10""",
)
def _(spark, d):
    top = recommending.top_rated_items(tables.items(spark, d), 10)
    return top.withColumn("genres", F.array_join("genres", ",")).withColumn("score", F.round("score", 6))


@query(
    "split_genres",
    f"WITH {ITEMS} SELECT id, trim(unnest(string_split(genre, '|'))) AS genre FROM items",
)
def _(spark, d):
    return tables.items(spark, d).select("id", F.explode(split_genres(F.col("genre"))).alias("genre"))
