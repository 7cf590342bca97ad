"""End-to-end jobs: train and recommend, answer questions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.functions import guards
from tastegrid.operators import cleaning, evaluating, factors, prompting, recommending, retrieval
from tastegrid.session import written

# fixed values: training defaults
N_COMPONENTS = 50
TEST_SIZE = 0.2
SEED = 42


class TrainedModel:
    """Factors of the training users, the cleaned tables and the training figures."""

    def __init__(self, fitted: factors.Factors, items: DataFrame, ratings: DataFrame, weights: DataFrame, metrics: DataFrame):
        self.factors, self.items, self.ratings, self.weights, self.metrics = fitted, items, ratings, weights, metrics


def train(
    items: DataFrame,
    ratings: DataFrame,
    item_order: Sequence[str],
    rating_order: Sequence[str],
    sample_size: int | None = None,
    n_components: int = N_COMPONENTS,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
    iterations: int = 5,
) -> TrainedModel:
    """Clean, sample, weigh the content, split the users, fit the factors and measure the error.

    ``metrics`` is a one-row table: n_users, n_items, n_ratings, n_train_users, train_mse.
    """
    items = cleaning.clean_items(items, item_order)
    ratings = cleaning.clean_ratings(ratings, rating_order).select("user_id", "item_id", "rating")
    if sample_size:
        items, ratings = cleaning.sample_users(items, ratings, sample_size, seed)
    ratings = written(ratings, "ratings")
    training = cleaning.train_test_split_users(ratings, test_size, seed).where("not is_test").drop("is_test")
    fitted = factors.fit_svd(training, n_components, seed, iterations)
    mse = factors.train_mse(training, fitted.user_factors, fitted.item_factors, dims=len(fitted.singular_values))
    shape = recommending.matrix_shape(ratings).first()  # one row of figures
    known = training.select("user_id").distinct().count()
    metrics = mse.select(
        F.lit(shape["n_users"]).alias("n_users"),
        F.lit(shape["n_items"]).alias("n_items"),
        F.lit(shape["n_rated"]).alias("n_ratings"),
        F.lit(known).alias("n_train_users"),
        "train_mse",
    )
    return TrainedModel(fitted, items, ratings, recommending.item_weights(items), metrics)


def training_metrics(model: TrainedModel, name: str) -> DataFrame:
    """Rows for ``append_metric``: training completed, and its error."""
    completed = F.struct(F.lit("TrainingCompleted").alias("name"), F.lit(1.0).alias("value"), F.lit("Count").alias("unit"))
    error = F.struct(F.lit("TrainingMSE").alias("name"), F.col("train_mse").alias("value"), F.lit("None").alias("unit"))
    rows = model.metrics.select(F.explode(F.array(completed, error)).alias("m")).select("m.*")
    return rows.withColumn("dimensions", F.create_map(F.lit("Model"), F.lit(name))).withColumn("ts", F.current_timestamp())


def recommend_all_users(model: TrainedModel, users: DataFrame, k: int = 10, candidates: DataFrame | None = None, order: str = "id") -> DataFrame:
    """user_id, item_id, title, score, genres, rank for every given user; users without factors get the fallback list."""
    known, cold = recommending.known_vs_cold_users(users, model.factors.user_factors)
    history = recommending.topn_history(model.ratings.join(known, "user_id", "left_semi"))
    wanted = model.factors.user_factors.join(known, "user_id", "left_semi")
    top = recommending.hybrid_recommend(wanted, model.factors.item_factors, history, model.weights, k, candidates=candidates)
    warm = recommending.recs_with_metadata(top, model.items)
    return recommending.warm_cold_union(warm, cold, recommending.popular_items(model.items, k, order))


def answer_questions(
    questions: DataFrame,
    docs: DataFrame,
    respond: Callable[[DataFrame], DataFrame],
    top_k: int = 5,
    strategy: str = "meta_prompt",
    filters: dict | None = None,
    min_score: float | None = retrieval.MIN_SCORE,
    digits: int = 9,
    model: str = "digest",
) -> DataFrame:
    """query_id, status, answer, sources, grounded, confidence for (query_id, query).

    Rejects by the input check, searches with the cleaned question, builds the prompt, takes the answer
    from ``respond`` (prompts -> response column) and judges grounding and output.
    """
    checked = questions.withColumn("_in", guards.validate_input(F.col("query")))
    passed = checked.where("_in.passed").select("query_id", F.col("_in.sanitized_text").alias("query"))
    rejected = checked.where("not _in.passed").select("query_id", "query")
    embedded = retrieval.embed_text(passed, "query", model)
    used = min(top_k, 5)
    hits = retrieval.vector_topk(embedded, docs, used, filters, min_score, digits=digits)
    named = [c for c in ("title", "genre", "year", "rating", "director", "cast", "plot") if c in docs.columns]
    fields = hits.join(docs.select("id", *named), "id").select(
        "query_id", F.struct("rank", "id", *named, F.col("score").alias("relevance")).alias("_d")
    )
    # at most five rows per question
    context = fields.groupBy("query_id").agg(F.array_sort(F.collect_list("_d")).alias("context"))
    asked = passed.join(context, "query_id", "left")
    asked = asked.withColumn("context", F.coalesce("context", F.array().cast(asked.schema["context"].dataType)))
    prompts = prompting.build_prompts(asked, [strategy])
    answered = evaluating.answer_from_responses(respond(prompts))
    judged = answered.join(asked.select("query_id", "context"), "query_id").withColumn(
        "_ok", guards.validate_output(F.col("answer"), F.col("context"))["passed"]
    )
    result = judged.select(
        "query_id",
        F.lit("answered").alias("status"),
        "answer",
        "sources",
        "grounded",
        F.when(F.col("_ok"), F.col("confidence")).otherwise("LOW").alias("confidence"),
    )

    def missing(c: str) -> Column:
        return F.lit(None).cast(result.schema[c].dataType).alias(c)

    refused = rejected.select("query_id", F.lit("rejected").alias("status"), *[missing(c) for c in ("answer", "sources", "grounded", "confidence")])
    return result.unionByName(refused)
