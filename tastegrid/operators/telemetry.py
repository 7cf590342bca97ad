"""Rates, histograms, quantiles and gauges over event tables (batch or stream)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.operators.quantiles import exact_percentiles

# fixed values: histogram bounds
BUCKETS = {
    "http_request_duration": [0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0],
    "inference_duration": [0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0],
    "llm_request_duration": [0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0],
    "tokens_per_request": [50, 100, 250, 500, 1000, 2500, 5000, 10000],
    "retrieval_duration": [0.01, 0.05, 0.1, 0.25, 0.5, 1.0],
    "documents_retrieved": [1, 2, 3, 5, 10, 20],
    "relevance_score": [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0],
    "guardrail_duration": [0.001, 0.005, 0.01, 0.025, 0.05, 0.1],
    "experiment_score": [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0],
}
SLO = {"p95_seconds": 0.5, "error_rate": 0.01, "failed_rate": 0.05}
# ---- end of fixed values ----


#: Values that a quantile sketch keeps.
SKETCH_K = 4096


def _seconds(duration: str) -> int:
    n, unit = duration.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}[unit.rstrip("s")]


def _window_start(width: str) -> Column:
    return F.window("ts", width)["start"].alias("window_start")


def counter_rate(log: DataFrame, width: str = "5 minutes", labels: Sequence[str] = ()) -> DataFrame:
    """Events per second in tumbling windows, by labels."""
    counts = log.groupBy(_window_start(width), *labels).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("rate", F.col("n") / _seconds(width))


def counter_increase(log: DataFrame, width: str = "1 hour", labels: Sequence[str] = (), value: str | None = None) -> DataFrame:
    """Count (or sum of ``value``) in tumbling windows, by labels."""
    total = F.count(F.lit(1)) if value is None else F.sum(value)
    return log.groupBy(_window_start(width), *labels).agg(total.alias("increase"))


def sliding_increase(log: DataFrame, width: str, step: str, labels: Sequence[str] = (), value: str | None = None) -> DataFrame:
    """Trailing totals at every step: window_end, labels, increase.

    Events are counted per step first; only the step counts are copied to the windows that cover them.
    """
    w, s = _seconds(width), _seconds(step)
    if w % s:
        raise ValueError("width must be a multiple of step")
    total = F.count(F.lit(1)) if value is None else F.sum(value)
    slot = F.floor(F.unix_seconds("ts") / s).cast("long")
    steps = log.groupBy(slot.alias("_slot"), *labels).agg(total.alias("_n"))
    ends = F.explode(F.sequence(F.col("_slot") + 1, F.col("_slot") + w // s)).alias("_end")
    spread = steps.select(ends, *labels, "_n").groupBy("_end", *labels).agg(F.sum("_n").alias("increase"))
    return spread.select(F.timestamp_seconds(F.col("_end") * s).alias("window_end"), *labels, "increase")


def sliding_rate(log: DataFrame, width: str = "5 minutes", step: str = "1 minute", labels: Sequence[str] = ()) -> DataFrame:
    """Trailing events per second at every step."""
    out = sliding_increase(log, width, step, labels)
    return out.withColumn("rate", F.col("increase") / _seconds(width))


def error_ratio(log: DataFrame, width: str | None = None, labels: Sequence[str] = ()) -> DataFrame:
    """Share of 5xx responses, per window and labels."""
    keys = ([_window_start(width)] if width else []) + [F.col(c) for c in labels]
    return log.groupBy(*keys).agg((F.count_if(F.col("status") >= 500) / F.count(F.lit(1))).alias("error_ratio"))


def histogram_counts(log: DataFrame, value: str, bounds: Sequence[float], labels: Sequence = ()) -> DataFrame:
    """One row per label set: ``counts`` = cumulative counts per bound, the last one for +Inf."""
    sums = [F.count_if(F.col(value) <= b).alias(f"_b{i}") for i, b in enumerate(bounds)]
    wide = log.groupBy(*labels).agg(*sums, F.count(value).alias("_inf"), F.sum(value).alias("sum"))
    names = [c for c in wide.columns if not c.startswith("_") and c != "sum"]
    return wide.select(*names, F.array(*[f"_b{i}" for i in range(len(bounds))], "_inf").alias("counts"), "sum")


def histogram_buckets(log: DataFrame, value: str, bounds: Sequence[float], labels: Sequence = ()) -> DataFrame:
    """Long form: labels, le, n (cumulative)."""
    wide = histogram_counts(log, value, bounds, labels)
    les = F.array(*[F.lit(str(float(b))) for b in bounds], F.lit("+Inf"))
    names = [c for c in wide.columns if c not in ("counts", "sum")]
    pairs = F.explode(F.arrays_zip(les.alias("le"), F.col("counts").alias("n")))
    return wide.select(*names, pairs.alias("b")).select(*names, "b.le", "b.n")


def bucket_quantile(counts: Column, bounds: Sequence[float], q: float) -> Column:
    """Linear interpolation inside the first bucket that reaches q * N.

    The lower edge of the first bucket is 0; in the overflow bucket the answer is the last finite bound.
    """
    n = len(bounds)
    edges = F.array(F.lit(0.0), *[F.lit(float(b)) for b in bounds])
    total = counts[n]
    rank = F.lit(q) * total
    at = F.array_position(F.transform(counts, lambda c: c >= rank), F.lit(True)).cast("int") - 1  # 0-based bucket
    below = F.when(at > 0, counts[at - 1]).otherwise(F.lit(0))
    inside = edges[at] + (edges[at + 1] - edges[at]) * (rank - below) / (counts[at] - below)
    return F.when(total == 0, F.lit(None).cast("double")).when(at >= n, F.lit(float(bounds[-1]))).otherwise(inside)


def histogram_quantile(
    log: DataFrame, value: str, bounds: Sequence[float], qs: Sequence[float] = (0.5, 0.95, 0.99), labels: Sequence = ()
) -> DataFrame:
    """labels, q, value."""
    wide = histogram_counts(log, value, bounds, labels)
    names = [c for c in wide.columns if c not in ("counts", "sum")]
    rows = F.array(
        *[F.struct(F.lit(float(q)).alias("q"), bucket_quantile(F.col("counts"), bounds, q).alias("value")) for q in qs]
    )
    return wide.select(*names, F.explode(rows).alias("x")).select(*names, "x.q", "x.value")


def sliding_quantile(
    log: DataFrame,
    value: str,
    bounds: Sequence[float],
    qs: Sequence[float] = (0.5, 0.95, 0.99),
    width: str = "5 minutes",
    step: str = "1 minute",
    labels: Sequence[str] = (),
) -> DataFrame:
    """window_end, labels, q, value: quantiles of the trailing ``width`` at every step.

    Buckets are counted per step first; only these counts are copied to the windows that hold the step.
    """
    w, s = _seconds(width), _seconds(step)
    slot = F.floor(F.unix_micros("ts") / (s * 1_000_000)).alias("slot")
    steps = histogram_counts(log, value, bounds, [slot, *labels])
    size = len(bounds) + 1
    ends = F.explode(F.sequence(F.col("slot") + 1, F.col("slot") + w // s)).alias("_end")
    spread = steps.select(ends, *labels, "counts").groupBy("_end", *labels)
    sums = spread.agg(*[F.sum(F.col("counts")[i]).alias(f"_c{i}") for i in range(size)])
    counts = sums.withColumn("counts", F.array(*[f"_c{i}" for i in range(size)]))
    rows = F.array(
        *[F.struct(F.lit(float(q)).alias("q"), bucket_quantile(F.col("counts"), bounds, q).alias("value")) for q in qs]
    )
    named = counts.select(F.timestamp_seconds(F.col("_end") * s).alias("window_end"), *labels, F.explode(rows).alias("x"))
    return named.select("window_end", *labels, "x.q", "x.value")


def exact_latency_percentiles(log: DataFrame, value: str = "duration", qs: Sequence[float] = (0.95, 0.99)) -> DataFrame:
    return exact_percentiles(log, value, qs)


def quantile_sketches(
    log: DataFrame, value: str, labels: Sequence[str] = (), step: str = "1 minute", k: int = SKETCH_K
) -> DataFrame:
    """slot, labels, sketch: one mergeable KLL sketch (binary) of the values of each step.

    A sketch holds O(k) values however many it has seen; rows are sketched before the shuffle. Null values are left out.
    """
    slot = F.floor(F.unix_micros("ts") / (_seconds(step) * 1_000_000)).alias("slot")
    known = log.where(F.col(value).isNotNull())
    return known.groupBy(slot, *labels).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))


def sketched_quantiles(
    sketches: DataFrame,
    qs: Sequence[float] = (0.95, 0.99),
    labels: Sequence[str] = (),
    width: str | None = None,
    step: str = "1 minute",
    k: int = SKETCH_K,
) -> DataFrame:
    """labels, q, value, n (and window_end where a ``width`` is named): approximate quantiles of merged sketches.

    Sketches of steps are merged for the whole log, or for the trailing ``width`` at every step. The rank of a value is
    off by about 1.5 / k of the rows at most (99 % sure); up to k rows it is exact.
    """
    names = list(labels)
    if width is not None:
        wide, s = _seconds(width) // _seconds(step), _seconds(step)
        ends = F.explode(F.sequence(F.col("slot") + 1, F.col("slot") + wide))
        sketches = sketches.withColumn("_end", ends).withColumn("window_end", F.timestamp_seconds(F.col("_end") * s))
        names = ["window_end", *names]
    merged = sketches.groupBy(*names).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))
    counted = merged.withColumn("n", F.kll_sketch_get_n_double("sketch")).where("n > 0")  # no row for an empty log

    def at(q: float) -> Column:
        return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(q)))).alias("value")

    rows = F.array(*[F.struct(F.lit(float(q)).alias("q"), at(q)) for q in qs])
    return counted.select(*names, "n", F.explode(rows).alias("x")).select(*names, "x.q", "x.value", "n")


def slo_check(log: DataFrame, limits: dict = SLO) -> DataFrame:
    """One row: p95, error and failure rates, and whether each meets its target."""
    none = F.lit(None).cast("double")
    p95 = exact_percentiles(log, "duration", [0.95]).select(F.col("value").cast("double").alias("p95"), none.alias("e"), none.alias("f"))
    rates = log.select(none.alias("p95"), (F.col("status") >= 500).cast("double").alias("e"), (F.col("status") >= 400).cast("double").alias("f"))
    row = p95.unionByName(rates).agg(F.max("p95").alias("p95"), F.avg("e").alias("error_rate"), F.avg("f").alias("failed_rate"))
    return row.select(
        "p95",
        "error_rate",
        "failed_rate",
        (F.col("p95") < limits["p95_seconds"]).alias("p95_ok"),
        (F.col("error_rate") < limits["error_rate"]).alias("error_ok"),
        (F.col("failed_rate") < limits["failed_rate"]).alias("failed_ok"),
    )


def gauge_last(log: DataFrame, value: str, labels: Sequence[str], order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """The latest value per label set."""
    return log.groupBy(*labels).agg(F.max_by(value, F.struct(*order)).alias("value"))


def gauge_ratio(log: DataFrame, used: str, total: str, labels: Sequence[str], order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """Latest used / latest total per label set."""
    key = F.struct(*order)
    last = log.groupBy(*labels).agg(F.max_by(used, key).alias("_u"), F.max_by(total, key).alias("_t"))
    return last.select(*labels, F.when(F.col("_t") != 0, F.col("_u") / F.col("_t")).alias("ratio"))


def cache_hit_ratio(log: DataFrame, hit: Column, request: Column, width: str | None = None) -> DataFrame:
    """hits / (hits + requests)."""
    keys = [_window_start(width)] if width else []
    hits, requests = F.count_if(hit), F.count_if(request)
    return log.groupBy(*keys).agg(F.when(hits + requests > 0, hits / (hits + requests)).alias("hit_ratio"))


def avg_by(log: DataFrame, value: str, labels: Sequence[str]) -> DataFrame:
    return log.groupBy(*labels).agg(F.avg(value).alias("average"))


def request_log_metrics(log: DataFrame) -> DataFrame:
    """Requests and total duration by method, endpoint and status (an exception counts as 500)."""
    status = F.coalesce(F.col("status"), F.lit(500))
    return log.groupBy("method", "endpoint", status.alias("status")).agg(
        F.count(F.lit(1)).alias("requests"), F.sum("duration").alias("duration_sum")
    )


def token_usage(log: DataFrame, cost_per_1k: float = 0.0) -> DataFrame:
    """Per model: tokens, tokens per request, requests by outcome and an estimated cost."""
    ok = F.col("status") < 500
    return log.groupBy("model").agg(
        F.sum(F.when(ok, F.col("tokens")).otherwise(0)).alias("tokens"),
        F.avg(F.when(ok, F.col("tokens"))).alias("tokens_per_request"),
        F.count_if(ok).alias("succeeded"),
        F.count_if(~ok).alias("failed"),
        (F.sum(F.when(ok, F.col("tokens")).otherwise(0)) * cost_per_1k / 1000).alias("estimated_cost"),
    )


# fixed values: what names an error class, in order
ERROR_CLASSES = {
    "rate": ("429", "quota", "rate limit"),
    "auth": ("401", "unauthorized", "api key"),
    "model": ("404", "not found"),
}


def error_class(message: Column) -> Column:
    """rate / auth / model / other from an error message."""
    low, found = F.lower(message), F.lit("other")
    for name, needles in reversed(ERROR_CLASSES.items()):
        found = F.when(F.exists(F.array(*map(F.lit, needles)), lambda n: F.contains(low, n)), name).otherwise(found)
    return found


def strategy_runs_scores(runs: DataFrame, bounds: Sequence[float] = tuple(BUCKETS["experiment_score"])) -> DataFrame:
    """Runs by (strategy, variant) with the cumulative score histogram in long form."""
    return histogram_buckets(runs, "score", bounds, ["strategy", "variant"])
