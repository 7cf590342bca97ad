import random

import pytest
from pyspark.sql import functions as F

from tastegrid.operators import cleaning, ordering


def test_repeats_go_before_nulls(spark):
    items = spark.createDataFrame([(1, "Movie 1", 0), (1, "Movie 1", 1), (2, "Movie 2", 2)], "id long, title string, n long")
    ratings = spark.createDataFrame([(1, 1, 5.0, 0), (1, 1, 5.0, 1), (2, 2, 4.0, 2)], "user_id long, movie_id long, rating double, n long")
    assert cleaning.clean_items(items, ["n"]).count() == 2
    kept = cleaning.clean_ratings(ratings, ["n"], item="movie_id")
    assert kept.count() == 2
    assert dict(kept.dtypes)["user_id"] == "string"


def test_null_rows_drop(spark):
    items = spark.createDataFrame([(1, "Movie 1", 0), (2, None, 1), (None, "Movie 3", 2)], "id long, title string, n long")
    ratings = spark.createDataFrame([(1, 1, 5.0, 0), (2, None, 4.0, 1), (3, 3, None, 2)], "user_id long, movie_id long, rating double, n long")
    assert [r["id"] for r in cleaning.clean_items(items, ["n"]).collect()] == ["1"]
    assert cleaning.clean_ratings(ratings, ["n"], item="movie_id").count() == 1


def test_sample_keeps_n_users_and_their_items(spark):
    ratings = spark.range(200).select(
        (F.col("id") % 20).cast("string").alias("user_id"), (F.col("id") % 7).cast("string").alias("item_id"), F.lit(1.0).alias("rating")
    )
    items = spark.range(10).select(F.col("id").cast("string").alias("id"))
    kept_items, kept = cleaning.sample_users(items, ratings, 5)
    assert kept.select("user_id").distinct().count() == 5
    assert kept_items.count() == 7
    assert cleaning.sample_users(items, ratings, 50)[1].count() == 200


def test_filters(spark):
    docs = spark.createDataFrame(
        [(1, "Avatar", "Action|Sci-Fi", 2009, 7.2, "James Cameron"), (2, "Titanic", "Drama|Romance", 1997, 7.5, "James Cameron"),
         (3, "The Avengers", "Action|Adventure", 2012, 7.4, "Joss Whedon")],
        "id int, title string, genre string, year int, rating double, director string",
    )

    def ids(filters):
        return sorted(r["id"] for r in cleaning.match_filters(docs, filters).collect())

    assert ids({"genre": "action"}) == [1, 3]
    assert ids({"director": "CAMERON", "year_max": 2000}) == [2]
    assert ids({"year_min": 2009, "rating_min": 7.4}) == [3]
    assert ids({"colour": "red"}) == [1, 2, 3]
    assert ids({"genre": "western"}) == []


def test_requests(spark):
    df = spark.createDataFrame([("u", 10), ("", 10), (None, 5), ("v", 101), ("w", None)], "user_id string, top_k int")
    good, bad = cleaning.split_requests(df, "predict")
    assert sorted(r["user_id"] for r in good.collect()) == ["u", "w"]
    assert bad.count() == 3


@pytest.mark.parametrize("n", [1, 7, 100])
def test_global_position_with_a_hot_value(spark, n):
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("v"), "id")
    rows = ordering.global_position(df, ["v", "id"]).collect()
    expected = sorted((r["v"], r["id"]) for r in rows)
    assert [(r["v"], r["id"]) for r in sorted(rows, key=lambda r: r["position"])] == expected
    assert sorted(r["position"] for r in rows) == list(range(n))


def test_split_is_positional(spark):
    df = spark.range(11).select((10 - F.col("id")).alias("v"))
    parts = {r["v"]: r["part"] for r in ordering.split_at_fraction(df, ["v"]).collect()}
    assert [parts[v] for v in range(11)] == ["reference"] * 7 + ["current"] * 4


def test_running_totals_cross_buckets(spark):
    df = spark.range(50).select((F.col("id") % 2).alias("k"), "id", F.lit(1).alias("one"))
    out = ordering.running_totals(df, ["k"], F.floor(F.col("id") / 7), ["id"], {"one": "run"}).collect()
    assert all(r["run"] == r["id"] // 2 + 1 for r in out)


@pytest.mark.parametrize("sample", [7, 40, 10_000])
def test_selection_with_nulls_hot_keys_and_ties(spark, sample):
    """The row at any rank, and the split, against a sorted list; a third of the rows has one key."""
    rng = random.Random(3)
    rows = [(None if i % 11 == 0 else 5 if i % 3 == 0 else rng.randrange(40), rng.choice("abé"), i) for i in range(300)]
    df = spark.createDataFrame(rows, "v int, s string, id long")
    listed = sorted(((-1 if v is None else v, s) for v, s, _ in rows))
    for rank in (0, 29, 80, 150, 299):
        key, before = ordering.select_rank(df, ["v", "s"], rank, 300, sample)
        want = listed[rank]
        assert (-1 if key[0] is None else int(key[0]), key[1]) == want and before == listed.index(want)
    for fraction in (0.0, 0.1, 0.3, 0.7, 1.0):
        got = ordering.split_at_fraction(df, ["v", "s"], fraction).collect()
        assert sorted(r["id"] for r in got) == list(range(300))
        first = sorted((-1 if r["v"] is None else r["v"], r["s"]) for r in got if r["part"] == "reference")
        assert first == listed[: int(300 * fraction)]
    assert ordering.split_at_fraction(df.where("id < 0"), ["v"]).count() == 0


def test_a_split_neither_sorts_nor_shuffles(spark):
    df = spark.range(5000).select(F.timestamp_seconds("id").alias("ts"), "id")
    split = ordering.split_at_fraction(df, ["ts", "id"])
    assert {r["part"]: r["n"] for r in split.groupBy("part").agg(F.count("*").alias("n")).collect()} == {"reference": 3500, "current": 1500}
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
