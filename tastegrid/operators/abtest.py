"""A/B assignment and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.functions.hashing import ab_bucket

# fixed values: the experiments that exist
EXPERIMENTS = {
    "prompt_experiment": {
        "enabled": True,
        "variants": ["zero_shot", "few_shot_k3", "meta_prompt"],
        "weights": [0.2, 0.3, 0.5],
    }
}


def ab_assign(experiment: str, user: Column, experiments: dict = EXPERIMENTS) -> Column:
    """Variant of a user: the first whose cumulative weight exceeds the user's bucket, else the last.

    A disabled experiment gives its last variant, an unknown one ``default``.
    """
    config = experiments.get(experiment)
    if config is None:
        return F.lit("default")
    last = F.lit(config["variants"][-1])
    if not config["enabled"]:
        return last
    bucket, total, ladder = ab_bucket(F.lit(experiment), user), 0.0, None
    for variant, weight in zip(config["variants"], config["weights"]):
        total += weight
        below = bucket < F.lit(total)
        ladder = F.when(below, variant) if ladder is None else ladder.when(below, variant)
    return ladder.otherwise(last)


def ab_impressions(df: DataFrame) -> DataFrame:
    return df.groupBy("experiment", "variant").agg(F.count(F.lit(1)).alias("impressions"))


def conversion_by_variant(df: DataFrame, impression: Column, conversion: Column) -> DataFrame:
    """Impressions, conversions and their ratio (null without impressions) by experiment and variant."""
    counts = df.groupBy("experiment", "variant").agg(
        F.count_if(impression).alias("impressions"), F.count_if(conversion).alias("conversions")
    )
    ratio = F.when(F.col("impressions") > 0, F.col("conversions") / F.col("impressions"))
    return counts.withColumn("conversion_rate", ratio)
