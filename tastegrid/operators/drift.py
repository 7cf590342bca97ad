"""Drift and data quality between a reference and a current table."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, NumericType

from tastegrid.operators.quantiles import exact_percentiles
from tastegrid.session import settle

# fixed values: report thresholds
SMALL_REFERENCE = 1000
P_THRESHOLD = 0.05
DISTANCE_THRESHOLD = 0.1
DRIFT_SHARE = 0.5
STD_FLOOR = 0.001
HIGH_LEVEL, MODERATE_LEVEL = 0.15, 0.05
MISSING_ALERT = 5.0
KS_TERMS = 100


def stack_parts(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One table with ``part`` = reference / current."""
    ref = reference.select(*columns).withColumn("part", F.lit("reference"))
    return ref.unionByName(current.select(*columns).withColumn("part", F.lit("current")))


def _share(count: str, total: str) -> Column:
    """A count over its total; null where a side has no values."""
    return F.try_divide(F.col(count).cast("double"), F.col(total).cast("double"))


def counted_values(stacked: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name, num, text, n_ref, n_cur, _bucket: every distinct value of every column once, nulls left out.

    One scan and one shuffle for all columns (numbers in ``num``, the rest in ``text``). The counts are written out
    in the order of (column, value), cut into ranges; ``_bucket`` is the range. Equal values are one row by then,
    so a hot value or column is spread like any other.
    """
    def entry(c: str) -> Column:
        number = isinstance(stacked.schema[c].dataType, NumericType)
        none = F.lit(None)
        return F.struct(
            F.lit(c).alias("column_name"),
            (F.col(c) if number else none).cast("double").alias("num"),
            (none if number else F.col(c)).cast("string").alias("text"),
        )

    long = stacked.select("part", F.explode(F.array(*[entry(c) for c in columns])).alias("x")).select("part", "x.*")
    counts = long.where("num IS NOT NULL OR text IS NOT NULL").groupBy("column_name", "num", "text").agg(
        F.count_if(F.col("part") == "reference").alias("n_ref"), F.count_if(F.col("part") == "current").alias("n_cur")
    )
    return settle(counts.repartitionByRange("column_name", "num", "text").withColumn("_bucket", F.spark_partition_id()))


def column_totals(counts: DataFrame) -> DataFrame:
    """column_name, n_values, n_ref, n_cur, spread: one row per column; spread is the reference's standard deviation."""
    size = F.col("n_ref").cast("double")
    sums = counts.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n_values"), F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"),
        F.try_divide(F.sum(F.when(size > 0, F.col("num") * size)), F.sum(size)).alias("_mean"),
    )
    apart = F.col("num") - F.col("_mean")  # from the mean, not from sums of squares
    spread = counts.join(F.broadcast(sums), "column_name").groupBy("column_name").agg(
        F.sqrt(F.try_divide(F.sum(F.when(size > 0, apart * apart * size)), F.sum(size))).alias("spread")
    )
    return sums.drop("_mean").join(F.broadcast(spread), "column_name")


def merged_cdf(counts: DataFrame) -> DataFrame:
    """column_name, value, next_value, f, g: both empirical distribution functions at every distinct number of a column.

    Running sums inside a bucket, offsets from one row per (column, bucket): no window holds a whole column.
    """
    totals = counts.groupBy("column_name").agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))
    numbers = counts.where(F.col("num").isNotNull())
    per_bucket = numbers.groupBy("column_name", "_bucket").agg(
        F.min("num").alias("_first"), F.sum("n_ref").alias("_r"), F.sum("n_cur").alias("_c")
    )
    ordered = Window.partitionBy("column_name").orderBy("_bucket")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        "column_name", "_bucket", F.lead("_first").over(ordered).alias("_next_first"),
        F.coalesce(F.sum("_r").over(before), F.lit(0)).alias("_o_ref"), F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_o_cur"),
    )
    inside = Window.partitionBy("column_name", "_bucket").orderBy("num")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = numbers.select(
        "column_name", "_bucket", F.col("num").alias("value"), F.lead("num").over(inside).alias("_next"),
        F.sum("n_ref").over(running).alias("_l_ref"), F.sum("n_cur").over(running).alias("_l_cur"),
    )
    # one row per range and column, one per column: safe to broadcast
    joined = local.join(F.broadcast(offsets), ["column_name", "_bucket"]).join(F.broadcast(totals), "column_name")
    joined = joined.withColumns({"c_ref": F.col("_l_ref") + F.col("_o_ref"), "c_cur": F.col("_l_cur") + F.col("_o_cur")})
    return joined.select(
        "column_name", "value", F.coalesce("_next", "_next_first").alias("next_value"), _share("c_ref", "t_ref").alias("f"), _share("c_cur", "t_cur").alias("g")
    )


def drift_statistics(stacked: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name, numeric, n_values, t_ref, t_cur and the statistics of each column: ks, ks_p and wasserstein of numbers,
    js and chi2 of the rest. One row per column, all from one set of counts; null statistics where a side is empty.
    """
    counts = counted_values(stacked, columns)
    totals = column_totals(counts)
    gap = F.abs(F.col("f") - F.col("g"))
    numbers = merged_cdf(counts).groupBy("column_name").agg(
        F.max(gap).alias("ks"), F.coalesce(F.sum(gap * (F.col("next_value") - F.col("value"))), F.lit(0.0)).alias("_area")
    )
    texts = counts.where(F.col("text").isNotNull()).join(F.broadcast(totals), "column_name")
    texts = texts.withColumns({"p": _share("n_ref", "t_ref"), "q": _share("n_cur", "t_cur")})
    mid = (F.col("p") + F.col("q")) / 2

    def kl(x: str) -> Column:
        return F.when(F.col(x) > 0, F.col(x) * F.log(F.col(x) / mid)).otherwise(F.lit(0.0))

    expected = F.col("n_ref") * F.try_divide(F.col("t_cur").cast("double"), F.col("t_ref").cast("double"))
    excess = F.when(expected > 0, (F.col("n_cur") - expected) ** 2 / expected).when(F.col("n_cur") > 0, float("inf")).otherwise(0.0)
    texts = texts.groupBy("column_name").agg((F.sum(kl("p") + kl("q")) / 2).alias("_divergence"), F.sum(excess).alias("_chi2"))
    listed = stacked.sparkSession.createDataFrame(
        [(c, isinstance(stacked.schema[c].dataType, NumericType)) for c in columns], "column_name string, numeric boolean"
    )
    full = (F.col("t_ref") > 0) & (F.col("t_cur") > 0)
    rows = listed.join(totals, "column_name", "left").join(numbers, "column_name", "left").join(texts, "column_name", "left")
    return rows.select(
        "column_name", "numeric", F.coalesce("n_values", F.lit(0)).alias("n_values"), "t_ref", "t_cur",
        F.when(full, F.col("ks")).alias("ks"),
        F.when(full, kolmogorov_p(F.col("ks"), F.col("t_ref"), F.col("t_cur"))).alias("ks_p"),
        F.when(full, F.col("_area") / F.greatest("spread", F.lit(STD_FLOOR))).alias("wasserstein"),
        F.when(full, F.sqrt(F.greatest("_divergence", F.lit(0.0)))).alias("js"),
        F.when(full, F.col("_chi2")).alias("chi2"),
    )


def kolmogorov_p(d: Column, n_ref: Column, n_cur: Column, terms: int = KS_TERMS) -> Column:
    """Two-sided p-value from the Kolmogorov series with a fixed number of terms."""
    n_ref, n_cur = n_ref.cast("double"), n_cur.cast("double")
    lam = d * F.sqrt(n_ref * n_cur / (n_ref + n_cur))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda s, j: s + F.when(j % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * j * j * lam * lam),
    )
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * series)))


def drift_numeric_ks(stacked: DataFrame, column: str) -> DataFrame:
    """One row: statistic D and p_value of the two-sample Kolmogorov-Smirnov test; nulls where a side is empty."""
    return drift_statistics(stacked, [column]).select(F.col("ks").alias("statistic"), F.col("ks_p").alias("p_value"))


def drift_numeric_wasserstein(stacked: DataFrame, column: str) -> DataFrame:
    """One row: Wasserstein distance divided by the reference standard deviation; null where a side is empty."""
    return drift_statistics(stacked, [column]).select(F.col("wasserstein").alias("statistic"))


def drift_categorical_js(stacked: DataFrame, column: str) -> DataFrame:
    """One row: Jensen-Shannon distance (natural log) of the category shares; null where a side is empty."""
    return drift_statistics(stacked, [column]).select(F.col("js").alias("statistic"))


def _chi2_tail(x: float, df: int) -> float:
    """P(chi-square with df degrees > x) by the regularised incomplete gamma function."""
    if df <= 0 or x != x:
        return float("nan")
    if math.isinf(x):
        return 0.0
    a, z = df / 2.0, x / 2.0
    if z <= 0:
        return 1.0
    front = math.exp(-z + a * math.log(z) - math.lgamma(a))
    if z < a + 1:  # series for the lower part
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-15:
            n += 1
            term *= z / n
            total += term
        return 1.0 - total * front
    b, c = z + 1 - a, 1e300  # continued fraction for the upper part
    d = 1.0 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        c = b + an / (c if abs(c) > 1e-300 else 1e-300)
        step = d * c
        h *= step
        if abs(step - 1) < 1e-15:
            break
    return front * h


@F.pandas_udf(DoubleType())
def chi2_p(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([_chi2_tail(float(a), int(b)) for a, b in zip(x, df)])


def drift_categorical_chi2(stacked: DataFrame, column: str) -> DataFrame:
    """One row: chi-square statistic of the current counts against the scaled reference shares, and p_value.

    Nulls where a side is empty.
    """
    row = drift_statistics(stacked, [column]).select(F.col("chi2").alias("statistic"), (F.col("n_values") - 1).alias("df"))
    return row.withColumn("p_value", F.when(F.col("statistic").isNotNull(), _tail("statistic", "df")))


def _tail(statistic: str, df: str) -> Column:
    return chi2_p(F.coalesce(statistic, F.lit(0.0)), F.coalesce(F.col(df).cast("double"), F.lit(1.0)))


def drift_level(score: Column) -> Column:
    """HIGH above 0.15, MODERATE above 0.05, else LOW."""
    return F.when(score > HIGH_LEVEL, "HIGH").when(score > MODERATE_LEVEL, "MODERATE").otherwise("LOW")


def drift_table(stacked: DataFrame, columns: Sequence[str], measure: str = "distance") -> DataFrame:
    """column_name, method, score, drifted, one row per column, by the ``measure`` that the caller names.

    "distance": Wasserstein or Jensen-Shannon, drifted at DISTANCE_THRESHOLD; "test": Kolmogorov-Smirnov or
    chi-square, drifted below P_THRESHOLD (the published rule takes it for references of SMALL_REFERENCE rows at
    most). An empty side has a null score and has not drifted. All columns share one scan and one set of counts.
    """
    if measure not in ("distance", "test"):
        raise ValueError(f"unknown measure: {measure}")
    rows = drift_statistics(stacked, columns).withColumn("df", F.col("n_values") - 1)
    if measure == "test":
        p = F.when(F.col("chi2").isNotNull(), _tail("chi2", "df"))
        score, drifted = F.when(F.col("numeric"), F.col("ks_p")).otherwise(p), F.col("score") < P_THRESHOLD
        method = F.when(F.col("numeric"), "ks").otherwise("chi2")
    else:
        score, drifted = F.when(F.col("numeric"), F.col("wasserstein")).otherwise(F.col("js")), F.col("score") >= DISTANCE_THRESHOLD
        method = F.when(F.col("numeric"), "wasserstein").otherwise("jensen_shannon")
    return rows.select("column_name", method.alias("method"), score.alias("score")).withColumn("drifted", F.coalesce(drifted, F.lit(False)))


def target_drift(stacked: DataFrame, column: str = "rating", measure: str = "distance") -> DataFrame:
    """The drift test on the target column; no row when the table has none."""
    if column not in stacked.columns:
        return stacked.sparkSession.createDataFrame([], "column_name string, method string, score double, drifted boolean")
    return drift_table(stacked, [column], measure)


def dataset_drift(per_column: DataFrame, share: float = DRIFT_SHARE) -> DataFrame:
    """One row: number and share of drifted columns, whether the dataset drifts, and the level."""
    row = per_column.agg(
        F.count(F.lit(1)).alias("n_columns"),
        F.count_if("drifted").alias("n_drifted"),
        F.avg(F.col("drifted").cast("double")).alias("drift_share"),
    )
    return row.withColumn("dataset_drift", F.col("drift_share") >= share).withColumn("level", drift_level(F.col("drift_share")))


def corpus_drift(reference: DataFrame, current: DataFrame, measure: str = "distance") -> DataFrame:
    """Drift of genre, year, rating and director (those that exist)."""
    columns = [c for c in ("genre", "year", "rating", "director") if c in reference.columns]
    return drift_table(stack_parts(reference, current, columns), columns, measure)


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("x")).select("x.column_name", "x.value")


def column_quality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name, n_rows, n_null, null_pct, n_distinct, constant, most_common, most_common_n.

    Values are counted per column in one shuffle; every figure is a sum over the counted values.
    """
    counted = _long(df, columns).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    present = F.when(F.col("value").isNotNull(), F.col("n"))
    out = counted.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
        F.count("value").alias("n_distinct"),
        F.max(present).alias("most_common_n"),
    )
    # ties go to the smallest value
    most = counted.where(F.col("value").isNotNull()).groupBy("column_name").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("most_common")
    )
    return (
        out.join(F.broadcast(most), "column_name", "left")  # one row per column
        .withColumn("null_pct", F.col("n_null") * 100.0 / F.col("n_rows"))
        .withColumn("constant", F.col("n_distinct") <= 1)
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: rows beyond the first of each set of equal rows."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.col("n") - 1).alias("n_duplicates"))


def numeric_quality(df: DataFrame, columns: Sequence[str], qs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """column_name, min, max, mean, std and one column per quantile (q25, q50, …)."""
    stats = df.agg(
        *[f(c).alias(f"{c}_{n}") for c in columns for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg), ("std", F.stddev))]
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}_{n}").cast("double").alias(n) for n in ("min", "max", "mean", "std")])
            for c in columns
        ]
    )
    long = stats.select(F.explode(rows).alias("x")).select("x.*")
    quantiles = None
    for c in columns:
        one = exact_percentiles(df, c, qs).groupBy(F.lit(c).alias("column_name")).agg(
            *[F.max(F.when(F.col("q") == q, F.col("value"))).alias(f"q{int(q * 100)}") for q in qs]
        )
        quantiles = one if quantiles is None else quantiles.unionByName(one)
    return long.join(F.broadcast(quantiles), "column_name")  # one row per column


def missing_alert(quality: DataFrame, limit: float = MISSING_ALERT) -> DataFrame:
    """Columns with more than ``limit`` percent nulls."""
    return quality.where(F.col("null_pct") > limit)


def numeric_columns(df: DataFrame) -> list[str]:
    """The columns of numbers, in the table's order."""
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def correlations(stacked: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """column_a, column_b, reference, current, change: Pearson correlations of all pairs of ``columns`` (all columns of
    numbers, unless named) in one pass."""
    pairs = list(combinations(numeric_columns(stacked) if columns is None else columns, 2))

    def on(part: str, c: str) -> Column:
        return F.when(F.col("part") == part, F.col(c).cast("double"))

    row = stacked.agg(
        *[
            F.corr(on(part, a), on(part, b)).alias(f"{part}_{i}")
            for i, (a, b) in enumerate(pairs)
            for part in ("reference", "current")
        ]
    )
    listed = F.array(
        *[
            F.struct(
                F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                F.col(f"reference_{i}").alias("reference"), F.col(f"current_{i}").alias("current"),
            )
            for i, (a, b) in enumerate(pairs)
        ]
    )
    long = row.select(F.explode(listed).alias("x")).select("x.*")
    return long.withColumn("change", F.col("current") - F.col("reference"))
