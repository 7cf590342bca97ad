"""Cleaning, sampling, filtering and validation of items, ratings and requests."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegrid.functions.hashing import hash_bucket
from tastegrid.operators.ordering import global_position


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key under an explicit order.

    ``row_number() = 1`` is planned with a group limit before the shuffle, so each map task sends at
    most one row per key and a key that holds a third of the table costs one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def clean_items(items: DataFrame, order: Sequence[str], id_col: str = "id", title_col: str = "title") -> DataFrame:
    """Drop repeated ids (first row stays), then rows without id or title; ids become strings."""
    kept = first_per_key(items, [id_col], order).dropna(subset=[id_col, title_col])
    return kept.withColumn(id_col, F.col(id_col).cast("string"))


def clean_ratings(
    ratings: DataFrame, order: Sequence[str], user: str = "user_id", item: str = "item_id", rating: str = "rating"
) -> DataFrame:
    """Drop repeated (user, item) pairs, then rows with a null; ids become strings."""
    kept = first_per_key(ratings, [user, item], order).dropna(subset=[user, item, rating])
    return kept.withColumns({c: F.col(c).cast("string") for c in (user, item)})


def distinct_users(ratings: DataFrame, user: str = "user_id") -> DataFrame:
    return ratings.select(user).distinct()


def distinct_items(ratings: DataFrame, item: str = "item_id") -> DataFrame:
    return ratings.select(item).distinct()


def pick_users(ratings: DataFrame, n: int, seed: int = 42, user: str = "user_id") -> DataFrame:
    """n users by the order of md5(seed:user): repeatable without a shared random state.

    Positions are counted over a range-partitioned layout, so the n users are never gathered in one task.
    """
    ranked = F.md5(F.concat(F.lit(f"{seed}:"), F.col(user).cast("string")))
    placed = global_position(distinct_users(ratings, user).withColumn("_ranked", ranked), ["_ranked", user], "_position")
    return placed.where(F.col("_position") < n).select(user)


def semi_sampled_users(ratings: DataFrame, users: DataFrame, user: str = "user_id") -> DataFrame:
    """Ratings of the given users."""
    return ratings.join(users.select(user), user, "left_semi")


def semi_rated_items(items: DataFrame, ratings: DataFrame, id_col: str = "id", item: str = "item_id") -> DataFrame:
    """Items with at least one rating."""
    rated = ratings.select(F.col(item).alias("_rated")).distinct()
    return items.join(rated, F.col(id_col) == F.col("_rated"), "left_semi")


def sample_users(
    items: DataFrame, ratings: DataFrame, n: int, seed: int = 42, user: str = "user_id", item: str = "item_id"
) -> tuple[DataFrame, DataFrame]:
    """(items, ratings) restricted to n users and the items those users rated."""
    kept = semi_sampled_users(ratings, pick_users(ratings, n, seed, user), user)
    return semi_rated_items(items, kept, item=item), kept


def train_test_split_users(users: DataFrame, test_size: float = 0.2, seed: int = 42, user: str = "user_id") -> DataFrame:
    """Adds ``is_test`` from a hash bucket of the user."""
    cut = int(round(test_size * 10_000))
    return users.withColumn("is_test", hash_bucket(F.col(user), seed) < cut)


def match_filters(docs: DataFrame, filters: dict) -> DataFrame:
    """genre / director: case-insensitive substring; year_min / year_max / rating_min: inclusive.

    Unknown keys are ignored; all given keys must hold.
    """

    def holds(text: str, needle: str) -> Column:
        return F.contains(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(needle.lower()))

    rules = {
        "genre": lambda v: holds("genre", v),
        "director": lambda v: holds("director", v),
        "year_min": lambda v: F.col("year") >= v,
        "year_max": lambda v: F.col("year") <= v,
        "rating_min": lambda v: F.col("rating") >= v,
    }
    for key, value in filters.items():
        if key in rules:
            docs = docs.where(rules[key](value))
    return docs


def search_filters(genre: str | None = None, year_min: int | None = None, year_max: int | None = None) -> dict:
    """Filters of a search request; only truthy values count."""
    given = {"genre": genre, "year_min": year_min, "year_max": year_max}
    return {k: v for k, v in given.items() if v}


def score_threshold(hits: DataFrame, min_score: float = 0.1, score: str = "score") -> DataFrame:
    return hits.where(F.col(score) >= min_score)


def context_cap(top_k: Column | int, cap: int = 5) -> Column:
    """Documents used for one query."""
    return F.least(F.lit(top_k) if isinstance(top_k, int) else top_k, F.lit(cap))


def fetch_by_id(docs: DataFrame, ids: Iterable | DataFrame, id_col: str = "id") -> DataFrame:
    """Documents by id; unknown ids give no row. ``ids`` is a short list or a table with ``id_col``."""
    if isinstance(ids, DataFrame):
        return docs.join(ids.select(id_col).distinct(), id_col, "left_semi")
    return docs.where(F.col(id_col).isin(list(ids)))


def drift_feature_select(df: DataFrame, features: Sequence[str] = ("genre", "year", "rating", "director")) -> DataFrame:
    """The monitored columns that exist, plus id and title."""
    return df.select(*[c for c in features if c in df.columns], "id", "title")


def max_samples(df: DataFrame, n: int, order: str = "id") -> DataFrame:
    return df.orderBy(order).limit(n)


# fixed values: request bounds, {request kind: {column: (low, high, rule)}}
REQUEST_BOUNDS = {
    "predict": {"user_id": (1, None, "length"), "top_k": (1, 100, "value")},
    "question": {"query": (1, 2000, "length"), "top_k": (1, 20, "value")},
    "search": {
        "query": (1, 500, "length"),
        "top_k": (1, 50, "value"),
        "year_min": (1900, 2030, "value"),
        "year_max": (1900, 2030, "value"),
    },
    "blurb": {"max_length": (20, 280, "value")},
    "reviews": {"reviews": (1, 10, "size")},
    "extract": {"text": (10, 5000, "length")},
    "recommendation": {"score": (0, 1, "value")},
}
REQUEST_DEFAULTS = {"predict": {"top_k": 10}, "question": {"top_k": 5}, "search": {"top_k": 10}, "blurb": {"max_length": 100}}
OPTIONAL_FIELDS = {"year_min", "year_max"}


def validate_requests(df: DataFrame, kind: str) -> DataFrame:
    """Fill defaults, then add ``valid`` and ``reject_reason`` (array of the failing columns)."""
    for column, default in REQUEST_DEFAULTS.get(kind, {}).items():
        df = df.withColumn(column, F.coalesce(F.col(column), F.lit(default))) if column in df.columns else df.withColumn(column, F.lit(default))
    reasons = []
    for column, (low, high, rule) in REQUEST_BOUNDS[kind].items():
        if column not in df.columns:
            continue
        c = F.col(column)
        measure = {"length": F.length, "size": F.size, "value": lambda x: x}[rule](c)
        ok = measure >= low if high is None else measure.between(low, high)
        missing = F.lit(column in OPTIONAL_FIELDS)
        reasons.append(F.when(~F.coalesce(ok, missing), F.lit(column)))
    failing = F.array_compact(F.array(*reasons))
    return df.withColumn("reject_reason", failing).withColumn("valid", F.size("reject_reason") == 0)


def split_requests(df: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows)."""
    checked = validate_requests(df, kind)
    return checked.where("valid"), checked.where("not valid")
