"""Guardrail operators on tables: registry, verdicts and counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.functions import guards

_FILTERS: dict[str, Callable[[Column], Column]] = {}


def register_filter(name: str, check: Callable[[Column], Column]) -> None:
    """Add a check: text column -> struct column with at least ``passed`` and ``message``.

    A model-backed check wraps an iterator pandas UDF that loads its model once per Python worker.
    """
    _FILTERS[name] = check


def registered_filters() -> list[str]:
    return list(_FILTERS)


register_filter("pii_filter", guards.pii_filter)
register_filter("prompt_injection_filter", guards.injection_filter)
register_filter("toxicity_filter", guards.toxicity_filter)
register_filter("content_policy_filter", guards.policy_filter)


def apply_filters(df: DataFrame, text: str, names: list[str] | None = None) -> DataFrame:
    """One struct column per named check, in one pass over the table."""
    names = registered_filters() if names is None else names
    unknown = [n for n in names if n not in _FILTERS]
    if unknown:
        raise ValueError(f"unknown filters: {unknown}")
    return df.select("*", *[_FILTERS[n](F.col(text)).alias(n) for n in names])


def violation_counts(df: DataFrame, result: str = "result") -> DataFrame:
    """Violations by (guardrail_type, severity)."""
    return (
        # the outer form adds no filter on the size of the list, which would work out all checks a second time
        df.select(F.explode_outer(F.col(result)["violations"]).alias("v"))
        .where("v is not null")
        .groupBy(F.col("v.guardrail_type").alias("guardrail_type"), F.col("v.severity").alias("severity"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def check_counts(df: DataFrame, guardrail_type: str, result: str = "result") -> DataFrame:
    """Checks by (guardrail_type, pass/fail)."""
    outcome = F.when(F.col(result)["passed"], "pass").otherwise("fail")
    return df.groupBy(F.lit(guardrail_type).alias("guardrail_type"), outcome.alias("result")).agg(
        F.count(F.lit(1)).alias("n")
    )


def qa_verdict(df: DataFrame, query: str, answer: str, context: str, include_sources: bool = True) -> DataFrame:
    """Input check, grounding, output check: status, confidence and the sources to return.

    Needs columns ``query``, ``answer`` and an array of context structs.
    """
    checked = df.withColumn("_in", guards.validate_input(F.col(query))).withColumn(
        "_out", guards.validate_output(F.col(answer), F.col(context))
    )
    grounding = guards.assess_grounding(F.col(answer), F.col(context))
    rejected = ~F.col("_in.passed")
    sources = F.col(context) if include_sources else F.slice(F.col(context), 1, 0)
    return (
        checked.withColumn("_g", grounding)
        .withColumn("status", F.when(rejected, "rejected").otherwise("answered"))
        .withColumn("sanitized_query", F.col("_in.sanitized_text"))
        .withColumn("grounded", F.when(~rejected, F.col("_g.grounded")))
        .withColumn(
            "confidence",
            F.when(rejected, F.lit(None).cast("string"))
            .when(~F.col("_out.passed"), "LOW")
            .otherwise(F.col("_g.confidence")),
        )
        .withColumn("sources", F.when(~rejected, sources))
        .drop("_in", "_out", "_g")
    )
