"""Answer evaluation and strategy comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegrid.functions import guards, scoring
from tastegrid.functions.text import jaccard_words, query_preview
from tastegrid.operators.prompting import build_prompts

# fixed value: the reply where nothing was found
NO_ANSWER = "I couldn't find relevant movie information for your question. Please try a different query."
SCORES = [
    "rouge_l_precision", "rouge_l_recall", "rouge_l_f1", "embedding_similarity",
    "factuality_score", "helpfulness_score", "relevance_score",
]


def evaluate_responses(
    df: DataFrame, similarity: Callable[[Column, Column], Column] = jaccard_words, rouge: Callable | None = scoring.rouge_l
) -> DataFrame:
    """Adds the seven scores to rows of (query, response, reference, context, error).

    A row with an error scores 0 everywhere; without a reference ROUGE and similarity are 0.
    """
    ok = F.col("error").isNull() | (F.col("error") == "")
    has_reference = ok & F.col("reference").isNotNull() & (F.col("reference") != "")

    def scored(cond: Column, value: Column) -> Column:
        return F.when(cond, value).otherwise(F.lit(0.0))

    if rouge is not None:
        df = df.withColumn("_rouge", rouge(F.col("response"), F.col("reference")))
    parts = ["rouge_l_precision", "rouge_l_recall", "rouge_l_f1"]
    df = df.withColumns({p: scored(has_reference, F.col("_rouge")[p]) if rouge is not None else F.lit(0.0) for p in parts})
    df = df.drop("_rouge").withColumns(
        {
            "embedding_similarity": scored(has_reference, similarity(F.col("response"), F.col("reference"))),
            "factuality_score": scored(ok, scoring.factuality_score(F.col("response"), F.col("context"))),
            "helpfulness_score": scored(ok, scoring.helpfulness_score(F.col("response"), F.col("query"))),
        }
    )
    return df.withColumn(
        "relevance_score", scoring.relevance_score(F.col("factuality_score"), F.col("helpfulness_score"))
    )


def export_rows(evaluated: DataFrame) -> DataFrame:
    """Flat rows for logging: query preview, response length, scores and run data."""
    return evaluated.select(
        "strategy",
        query_preview(F.col("query")).alias("query"),
        F.length("response").alias("response_length"),
        *SCORES,
        "latency_ms",
        "tokens_used",
        "cached",
        "error",
    )


def summarize_strategies(evaluated: DataFrame) -> DataFrame:
    """One row per strategy: means over error-free rows, tokens and error rate over all rows."""
    ok = F.col("error").isNull() | (F.col("error") == "")

    def mean(c: str, name: str) -> Column:
        return F.coalesce(F.avg(F.when(ok, F.col(c))), F.lit(0.0)).alias(name)

    return evaluated.groupBy("strategy", "ordinal").agg(
        F.count(F.lit(1)).alias("num_samples"),
        mean("rouge_l_f1", "rouge_l_f1"),
        mean("embedding_similarity", "embedding_similarity"),
        mean("factuality_score", "factuality"),
        mean("helpfulness_score", "helpfulness"),
        mean("latency_ms", "latency_ms"),
        F.sum("tokens_used").alias("tokens"),
        F.avg(F.when(ok, 0.0).otherwise(1.0)).alias("error_rate"),
    )


def _efficiency() -> Column:
    return (F.col("rouge_l_f1") + F.col("factuality") / 5) / F.greatest(F.col("tokens"), F.lit(1)) * 10000


def compare_strategies(summary: DataFrame) -> DataFrame:
    """One row with the winner per metric; ties go to the earliest strategy."""
    latency = F.when(F.col("latency_ms") > 0, F.col("latency_ms")).otherwise(F.lit(float("inf")))
    metrics = {
        "best_rouge_l": F.col("rouge_l_f1"),
        "best_embedding_sim": F.col("embedding_similarity"),
        "best_factuality": F.col("factuality"),
        "best_helpfulness": F.col("helpfulness"),
        "fastest": -latency,
        "most_efficient": _efficiency(),
    }
    return summary.agg(
        *[F.max_by("strategy", F.struct(value, -F.col("ordinal"))).alias(name) for name, value in metrics.items()]
    )


def sort_strategies(summary: DataFrame) -> DataFrame:
    """Rank of every strategy per metric (1 = best), in long form; a handful of rows."""
    latency = F.when(F.col("latency_ms") > 0, F.col("latency_ms")).otherwise(F.lit(float("inf")))
    long = summary.select(
        "strategy",
        F.explode(
            F.create_map(
                F.lit("rouge_l"), F.col("rouge_l_f1"), F.lit("embedding_sim"), F.col("embedding_similarity"),
                F.lit("factuality"), F.col("factuality"), F.lit("helpfulness"), F.col("helpfulness"),
                F.lit("speed"), -latency, F.lit("efficiency"), _efficiency(),
            )
        ).alias("metric", "value"),
    )
    w = Window.partitionBy("metric").orderBy(F.desc(F.round("value", 9)))
    return long.select("metric", "strategy", F.rank().over(w).alias("rank"))


def fewshot_delta(summary: DataFrame) -> DataFrame:
    """k=3 against k=5: more examples help iff ROUGE-L is higher."""
    def pick(k: int, c: str) -> Column:
        return F.max(F.when(F.col("strategy") == f"few_shot_k{k}", F.col(c)))

    row = summary.agg(
        pick(3, "rouge_l_f1").alias("k3_rouge_l"),
        pick(5, "rouge_l_f1").alias("k5_rouge_l"),
        pick(3, "factuality").alias("k3_factuality"),
        pick(5, "factuality").alias("k5_factuality"),
    )
    return row.withColumn("more_examples_better", F.col("k5_rouge_l") > F.col("k3_rouge_l"))


def run_experiment(
    samples: DataFrame,
    responses: Callable[[DataFrame], DataFrame],
    strategies: str | list[str] = "all",
    context_provider: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(evaluated rows, summary, comparison) for strategies x samples in one plan.

    ``context_provider`` maps (query_id, query) to (query_id, context); ``responses`` attaches response,
    latency_ms, tokens_used, cached and error to the prompts (a join with a recorded-response table).
    """
    if context_provider is not None:
        found = context_provider(samples.select("query_id", "query"))
        samples = samples.drop("context").join(found, "query_id", "left")
        empty = F.array().cast(samples.schema["context"].dataType)
        samples = samples.withColumn("context", F.coalesce("context", empty))
    evaluated = evaluate_responses(responses(build_prompts(samples, strategies)))
    summary = summarize_strategies(evaluated)
    return evaluated, summary, compare_strategies(summary)


def answer_from_responses(df: DataFrame) -> DataFrame:
    """query, context, response -> answer, sources, grounding; a fixed answer where no context was found."""
    empty = F.coalesce(F.size("context") <= 0, F.lit(True))
    g = guards.assess_grounding(F.col("response"), F.col("context"))
    sources = F.transform("context", lambda d: F.struct(d["id"].alias("id"), d["title"].alias("title")))
    return df.withColumn("_g", g).select(
        "query_id",
        "query",
        F.when(empty, F.lit(NO_ANSWER)).otherwise(F.col("response")).alias("answer"),
        F.when(~empty, sources).alias("sources"),
        F.when(empty, F.lit(False)).otherwise(F.col("_g.grounded")).alias("grounded"),
        F.when(empty, F.lit("LOW")).otherwise(F.col("_g.confidence")).alias("confidence"),
    )
