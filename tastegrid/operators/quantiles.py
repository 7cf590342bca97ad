"""Exact order statistics over counted distinct values.

Equal values are counted first (partial counts before the shuffle), so a value that holds a third of
the table is one row afterwards. The distinct values are then cut into buckets at sketched quantiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastegrid.session import settle

#: Distinct values of one bucket, which is one window task.
BUCKET_VALUES = 100_000


def with_buckets(counted: DataFrame, value: str, buckets: int | None = None, out: str = "_bucket") -> DataFrame:
    """Adds a bucket number that grows with ``value``; bounds come from a quantile sketch.

    There are as many buckets as keep each at about BUCKET_VALUES distinct values, unless the caller says how many.
    """
    if buckets is None:
        buckets = max(2, -(-counted.count() // BUCKET_VALUES))
    qs = [i / buckets for i in range(1, buckets)]
    bounds = counted.agg(F.percentile_approx(value, qs, 10_000).alias("b")).first()["b"] or []
    splits = [-float("inf"), *sorted({float(b) for b in bounds}), float("inf")]
    if len(splits) < 3:
        splits.insert(1, 0.0)
    cut = Bucketizer(splits=splits, inputCol=value, outputCol=out, handleInvalid="keep").transform(counted)
    return cut.withColumn(out, F.col(out).cast("int"))


def cumulative(counted: DataFrame, value: str, sums: dict[str, str], buckets: int | None = None) -> DataFrame:
    """Inclusive running sums along ``value`` plus ``next_value``, the next larger distinct value.

    ``counted`` has one row per value. Windows run inside one bucket; offsets come from the one row per bucket.
    """
    rows = with_buckets(counted, value, buckets)
    per_bucket = rows.groupBy("_bucket").agg(
        F.min(value).alias("_first"), *[F.sum(c).alias(f"_t_{c}") for c in sums]
    )
    ordered = Window.orderBy("_bucket")  # one row per bucket: a few dozen rows
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        "_bucket",
        F.lead("_first").over(ordered).alias("_next_first"),
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums],
    )
    inside = Window.partitionBy("_bucket").orderBy(value)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = rows.select(
        value,
        "_bucket",
        F.lead(value).over(inside).alias("_next"),
        *[F.sum(c).over(running).alias(f"_l_{c}") for c in sums],
    ).join(F.broadcast(offsets), "_bucket")
    return joined.select(
        value,
        F.coalesce("_next", "_next_first").alias("next_value"),
        *[(F.col(f"_l_{c}") + F.col(f"_o_{c}")).alias(out) for c, out in sums.items()],
    )


def exact_percentiles(df: DataFrame, value: str, qs: Sequence[float]) -> DataFrame:
    """q, value rows by linear interpolation between the closest ranks, exact at any size."""
    counted = settle(
        df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    )
    total = counted.agg(F.sum("n").alias("n")).first()["n"] or 0
    cdf = cumulative(counted, "v", {"n": "cum"})
    ranks = F.array(
        *[
            F.struct(
                F.lit(float(q)).alias("q"),
                F.lit(int(q * (total - 1))).alias("lo"),
                F.lit(min(int(q * (total - 1)) + 1, max(total - 1, 0))).alias("hi"),
                F.lit(q * (total - 1) - int(q * (total - 1))).alias("frac"),
            )
            for q in qs
        ]
    )
    # the value at 0-based rank r is the smallest one whose running count exceeds r
    return (
        cdf.select("v", "cum", F.explode(ranks).alias("r"))
        .groupBy(F.col("r.q").alias("q"), F.col("r.frac").alias("frac"))
        .agg(
            F.min(F.when(F.col("cum") > F.col("r.lo"), F.col("v"))).alias("lo"),
            F.min(F.when(F.col("cum") > F.col("r.hi"), F.col("v"))).alias("hi"),
        )
        .select("q", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("frac")).alias("value"))
    )
