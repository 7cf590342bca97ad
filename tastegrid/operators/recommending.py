"""Hybrid recommendations for all users at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastegrid.functions.text import split_genres
from tastegrid.operators import tfidf
from tastegrid.operators.nearest import score_range, thinned, topk_inner_product, topk_minmax_sum
from tastegrid.session import settle

# fixed values: score weights and the range guard
COLLAB_WEIGHT = 0.7
CONTENT_WEIGHT = 0.3
RANGE_GUARD = 1e-10
HISTORY = 5
COLD_SCORE = 0.5


def user_item_ratings(ratings: DataFrame) -> DataFrame:
    """Mean rating per (user, item): the long form of the user-item matrix."""
    return ratings.groupBy("user_id", "item_id").agg(F.avg("rating").alias("rating"))


def user_item_pivot(ratings: DataFrame, items: Sequence[str]) -> DataFrame:
    """Wide matrix for a short, named list of items; 0 where unrated."""
    return ratings.groupBy("user_id").pivot("item_id", list(items)).agg(F.avg("rating")).fillna(0.0)


def matrix_shape(user_item: DataFrame) -> DataFrame:
    """n_users, n_items, n_rated, density of the long matrix."""
    n = user_item.agg(
        F.count_distinct("user_id").alias("n_users"),
        F.count_distinct("item_id").alias("n_items"),
        F.count(F.lit(1)).alias("n_rated"),
    )
    return n.withColumn("density", F.col("n_rated") / (F.col("n_users") * F.col("n_items")))


def topn_history(ratings: DataFrame, n: int = HISTORY) -> DataFrame:
    """The user's n best-rated items (group-limited before the shuffle)."""
    w = Window.partitionBy("user_id").orderBy(F.desc("rating"), F.asc("item_id"))
    return ratings.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def history_profile(history: DataFrame, items: DataFrame, limit: int = HISTORY) -> DataFrame:
    """Distinct genres and directors of the first ``limit`` history items; ``liked`` names three genres.

    ``history`` has user_id, item_id, rank. At most ``limit`` rows per user meet in a group.
    """
    first = history.where(F.col("rank") <= limit)
    meta = items.select(F.col("id").alias("item_id"), "genre", "director")
    joined = first.join(meta, "item_id")
    profile = joined.groupBy("user_id").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(split_genres(F.col("genre")))))).alias("genres"),
        F.array_sort(F.collect_set("director")).alias("directors"),
    )
    return profile.withColumn("liked", F.array_join(F.slice("genres", 1, 3), ", "))


def known_vs_cold_users(users: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(users with factors, users without)."""
    ids = known.select("user_id").distinct()
    return users.join(ids, "user_id", "left_semi"), users.join(ids, "user_id", "left_anti")


def candidate_restrict(items: DataFrame, candidates: DataFrame, id_col: str = "item_id") -> DataFrame:
    """Only the candidate items are ranked."""
    return items.join(candidates.select(id_col).distinct(), id_col, "left_semi")


def score_collab(user_factors: DataFrame, item_factors: DataFrame, k: int = 10, digits: int = 9) -> DataFrame:
    """user_id, item_id, score, rank: the k best dot products per user over all items."""
    return topk_inner_product(user_factors, item_factors, k, "user_id", "item_id", digits=digits)


def minmax_per_user(user_factors: DataFrame, item_factors: DataFrame) -> DataFrame:
    """user_id, min_score, max_score, n_items over all items."""
    return score_range(user_factors, item_factors, "user_id", "item_id")


def topk_per_user(user_factors: DataFrame, item_factors: DataFrame, k: int = 10, digits: int = 9) -> DataFrame:
    """Top-k items per user with the score scaled to the user's own range; each product is worked out once."""
    top = topk_inner_product(user_factors, item_factors, k, "user_id", "item_id", digits=digits, extent=True)
    scaled = (F.col("score") - F.col("min_score")) / (F.col("max_score") - F.col("min_score") + RANGE_GUARD)
    return top.select("user_id", "item_id", "rank", scaled.alias("score"))


def item_weights(items: DataFrame, id_col: str = "id", max_features: int = tfidf.MAX_FEATURES) -> DataFrame:
    """item_id, slot, weight: TF-IDF of the items with numbered terms, written out once."""
    content = items.select(
        F.col(id_col).alias("item_id"),
        tfidf.item_content(F.col("genre"), F.col("plot"), F.col("title")).alias("content"),
    )
    weights = settle(tfidf.fit_tfidf(content, "content", "item_id", max_features))
    # at most max_features rows, so one window partition is enough to number them
    slots = weights.select("term").distinct().select("term", F.row_number().over(Window.orderBy("term")).alias("slot"))
    return weights.join(F.broadcast(slots), "term").select("item_id", "slot", "weight")


def content_profiles(history: DataFrame, weights: DataFrame) -> DataFrame:
    """user_id, slot, weight: mean item vector of the history (divisor = number of history items)."""
    sums = (
        history.select("user_id", "item_id")
        .join(weights, "item_id")
        .groupBy("user_id", "slot")
        .agg(F.sum("weight").alias("weight"))
    )
    n = history.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    return sums.join(n, "user_id").select("user_id", "slot", (F.col("weight") / F.col("_n")).alias("weight"))


def score_content(history: DataFrame, weights: DataFrame, k: int = 10, digits: int = 9) -> DataFrame:
    """user_id, item_id, score, rank: mean cosine to the history, the k best items per user."""
    profiles = tfidf.sparse(content_profiles(history, weights), "user_id", "slot")
    vectors = thinned(_item_vectors(weights), k, "item_id")
    return topk_inner_product(profiles, vectors, k, "user_id", "item_id", digits=digits)


def _item_vectors(weights: DataFrame) -> DataFrame:
    """item_id, vector with the slots in order, so that items of equal texts have equal vectors."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col("slot").cast("int").alias("s"), F.col("weight").alias("w"))))
    return weights.groupBy("item_id").agg(pairs.alias("_p")).select("item_id", tfidf.sparse_vector(F.col("_p")).alias("vector"))


def cosine_pairs(weights: DataFrame, k: int = 5, digits: int = 9) -> DataFrame:
    """For each item its k most similar other items by TF-IDF cosine; the n x n matrix is never built.

    Items of equal vectors are one query, whose k + 1 best serve all of them, each without itself.
    """
    vectors = settle(_item_vectors(weights))
    same = F.xxhash64("vector").alias("_h")
    asked = settle(vectors.groupBy(same, "vector").agg(F.min("item_id").alias("_first")))
    best = topk_inner_product(asked.select("_first", "vector"), thinned(vectors, k + 1, "item_id"), k + 1, "_first", "item_id", digits=digits)
    # at most k + 1 hits in a row
    hits = F.array_sort(F.collect_list(F.struct("rank", F.col("item_id").alias("right_id"), "score")))
    found = asked.join(best.groupBy("_first").agg(hits.alias("_hits")), "_first").drop("_first")
    members = vectors.select(F.col("item_id").alias("left_id"), same, "vector")
    others = F.slice(F.filter("_hits", lambda h: h["right_id"] != F.col("left_id")), 1, k)
    return members.join(found, ["_h", "vector"]).select("left_id", F.posexplode(others).alias("_at", "_r")).select(
        "left_id", "_r.right_id", "_r.score", (F.col("_at") + 1).alias("rank")
    )


def hybrid_recommend(
    user_factors: DataFrame,
    item_factors: DataFrame,
    history: DataFrame,
    weights: DataFrame,
    k: int = 10,
    collab_weight: float = COLLAB_WEIGHT,
    content_weight: float = CONTENT_WEIGHT,
    candidates: DataFrame | None = None,
    digits: int = 9,
) -> DataFrame:
    """user_id, item_id, score, rank of ``w1 * minmax(collab) + w2 * content``.

    Factors are the dense head and TF-IDF weights the sparse tail of one vector. Where the items travel at once, one
    product gives the range and the ranking; else the range comes first, the head is scaled by one number per user,
    and the weighted sum is one inner product whose offset is taken off at the end. The min-max range is over
    all items, whatever the candidates.
    """
    pairs = F.collect_list(F.struct(F.col("slot").alias("s"), F.col("weight").alias("w"))).alias("_p")
    profiles = content_profiles(history, weights).groupBy("user_id").agg(pairs)
    tail = F.transform("_p", lambda p: F.struct(p["s"].alias("s"), (p["w"] * content_weight).alias("w")))
    head = F.transform("_c", lambda x: x.cast("double"))
    users = user_factors.select("user_id", F.col("vector").alias("_c")).join(profiles, "user_id", "left")
    users = settle(users.select("user_id", tfidf.sparse_vector(tail, head).alias("vector")))
    items = item_factors.select("item_id", F.col("vector").alias("_c")).join(weights.groupBy("item_id").agg(pairs), "item_id", "left")
    items = items.select("item_id", tfidf.sparse_vector(F.col("_p"), head).alias("vector"), F.lit(True).alias("_ranked"))
    if candidates is not None:
        wanted = candidates.select("item_id").distinct().withColumn("_wanted", F.lit(True))
        items = items.join(wanted, "item_id", "left").select("item_id", "vector", F.coalesce("_wanted", F.lit(False)).alias("_ranked"))
    items = settle(items)
    top = topk_minmax_sum(users, items, k, collab_weight, RANGE_GUARD, "user_id", "item_id", "_ranked", digits)
    if top is not None:
        return top
    spread = F.col("max_score") - F.col("min_score") + RANGE_GUARD
    scaled = users.join(minmax_per_user(user_factors, item_factors), "user_id").withColumn("_f", F.lit(collab_weight) / spread)
    names = users.schema["vector"].dataType.names
    grown = F.transform(F.col("vector")[names[0]], lambda x: x * F.col("_f")).alias(names[0])
    vector = F.struct(grown, *[F.col("vector")[n].alias(n) for n in names[1:]]).alias("vector")
    asked = settle(scaled.select("user_id", vector, (F.col("min_score") * F.col("_f")).alias("offset")))
    best = topk_inner_product(asked, items.where("_ranked"), k, "user_id", "item_id", digits=digits)
    return best.join(asked.select("user_id", "offset"), "user_id").select(
        "user_id", "item_id", (F.col("score") - F.col("offset")).alias("score"), "rank"
    )


def popular_items(items: DataFrame, k: int = 10, order: str = "position", ratings: DataFrame | None = None) -> DataFrame:
    """Fallback list: the first k items with a constant score, or the k most-rated where ratings are given."""
    if ratings is None:
        first = items.orderBy(order).limit(k)
    else:
        n = ratings.groupBy(F.col("item_id").alias("id")).agg(F.count(F.lit(1)).alias("_n"))
        first = items.join(n, "id").orderBy(F.desc("_n"), "id").limit(k)
    return first.select(
        F.col("id").alias("item_id"), "title", F.lit(COLD_SCORE).alias("score"), split_genres(F.col("genre")).alias("genres")
    )


def top_rated_items(items: DataFrame, k: int = 10) -> DataFrame:
    """The k highest-rated items, score = rating / 5; the first k rows where there is no rating column."""
    rated = "rating" in items.columns
    ordered = items.orderBy(F.desc("rating"), "id") if rated else items.orderBy("id")
    rating = F.coalesce(F.col("rating"), F.lit(4.0)) if rated else F.lit(4.0)
    return ordered.limit(k).select(
        F.col("id").alias("item_id"), "title", (rating / 5.0).alias("score"), split_genres(F.col("genre")).alias("genres")
    )


def recs_with_metadata(top: DataFrame, items: DataFrame) -> DataFrame:
    """Attach title and genres after ranking; ids without an item drop out, so a user may get fewer than k."""
    meta = items.select(F.col("id").alias("item_id"), "title", split_genres(F.col("genre")).alias("genres"))
    return top.join(meta, "item_id")


def warm_cold_union(warm: DataFrame, cold_users: DataFrame, fallback: DataFrame) -> DataFrame:
    """Model rows for known users, the fallback list for the others.

    The k fallback rows travel as one array, so cold users are not joined with anything.
    """
    columns = ["item_id", "title", "score", "genres"]
    rows = [r.asDict() for r in fallback.select(*columns).collect()]  # k rows
    listed = F.array(
        *[
            F.struct(
                F.lit(r["item_id"]).alias("item_id"),
                F.lit(r["title"]).alias("title"),
                F.lit(r["score"]).alias("score"),
                F.array(*[F.lit(g) for g in r["genres"]]).cast("array<string>").alias("genres"),
            )
            for r in rows
        ]
    )
    cold = cold_users.select("user_id", F.posexplode(listed).alias("_at", "_r")).select(
        "user_id", "_r.*", (F.col("_at") + 1).alias("rank")
    )
    return warm.select("user_id", *columns, "rank").unionByName(cold)
