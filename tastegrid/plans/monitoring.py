"""Drift, telemetry and quota queries."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.operators import drift, quota, telemetry
from tastegrid.operators.ordering import split_at_fraction
from tastegrid.plans.registry import ADMISSION, CORPUS, LOG, RATINGS, query
from tastegrid.session import written
from tastegrid.sources import tables
from tastegrid.sources.tables import table

BOUNDS = telemetry.BUCKETS["http_request_duration"]
NTZ = "timestamp_ntz"


# ---- drift: the first 70 % of the raw ratings against the rest ----
ORDER = ["ts", "o_key", "line", "item_id", "rating"]


def stacked(spark: SparkSession, d: str) -> DataFrame:
    rows = tables.raw_ratings(spark, d).join(
        table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("item_id"), F.col("p_brand").alias("brand")), "item_id"
    )
    # the split reads its rows several times: they are joined once
    return split_at_fraction(written(rows, "ratings"), ORDER)


_SPLIT = f"""{RATINGS}, numbered AS (SELECT r.*, p_brand AS brand, row_number() OVER (ORDER BY ts, o_key, line, item_id, rating) - 1 AS pos
  FROM raw_ratings r JOIN part ON CAST(p_partkey AS VARCHAR) = item_id),
st AS (SELECT *, CASE WHEN pos < CAST(floor(0.7::DOUBLE * (SELECT count(*) FROM numbered)) AS BIGINT) THEN 'reference' ELSE 'current' END AS part
  FROM numbered)"""


def cdf_sql(source: str, column: str) -> str:
    return f"""vc AS (SELECT CAST({column} AS DOUBLE) AS v, count(*) FILTER (part = 'reference') AS r, count(*) FILTER (part = 'current') AS c
  FROM {source} WHERE {column} IS NOT NULL GROUP BY 1),
cdf AS (SELECT v, lead(v) OVER (ORDER BY v) AS nv, CAST(sum(r) OVER (ORDER BY v) AS DOUBLE) / (SELECT sum(r) FROM vc) AS f,
  CAST(sum(c) OVER (ORDER BY v) AS DOUBLE) / (SELECT sum(c) FROM vc) AS g FROM vc)"""


@query(
    "split_at_fraction",
    f"WITH {_SPLIT} SELECT part, CAST(count(*) AS BIGINT) AS n, sum(rating) AS total, min(ts) AS first_ts, max(ts) AS last_ts FROM st GROUP BY part",
)
def _(spark, d):
    s = split_at_fraction(written(tables.raw_ratings(spark, d), "ratings"), ORDER)
    return s.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("total"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


@query(
    "reference_current_split",
    """WITH n AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos FROM events)
SELECT event_id, CASE WHEN pos < CAST(floor(0.7::DOUBLE * (SELECT count(*) FROM n)) AS BIGINT) THEN 'reference' ELSE 'current' END AS part FROM n""",
)
def _(spark, d):
    return split_at_fraction(table(spark, d, "events").select("event_id", "ts"), ["ts", "event_id"]).select("event_id", "part")


def halves(spark: SparkSession, d: str) -> DataFrame:
    """events with the part of every row; value is continuous."""
    e = table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return split_at_fraction(e, ["ts", "event_id"])


_HALVES = """n AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos FROM events),
st AS (SELECT *, CASE WHEN pos < CAST(floor(0.7::DOUBLE * (SELECT count(*) FROM n)) AS BIGINT) THEN 'reference' ELSE 'current' END AS part FROM n)"""
_KS_P = """greatest(0.0, least(1.0, 2.0 * list_sum(list_transform(range(1, 101),
  lambda j: CASE WHEN j % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * j * j * lam * lam)))))"""


@query(
    "drift_numeric_ks",
    f"""WITH {_HALVES}, {cdf_sql('st', 'value')}, s AS (SELECT max(abs(f - g)) AS statistic FROM cdf),
l AS (SELECT statistic, statistic * sqrt((SELECT CAST(sum(r) AS DOUBLE) * sum(c) / (sum(r) + sum(c)) FROM vc)) AS lam FROM s)
SELECT round(statistic, 6) AS statistic, round(CASE WHEN lam < 0.2 THEN 1.0 ELSE {_KS_P} END, 6) AS p_value FROM l""",
)
def _(spark, d):
    row = drift.drift_numeric_ks(halves(spark, d), "value")
    return row.select(F.round("statistic", 6).alias("statistic"), F.round("p_value", 6).alias("p_value"))


@query(
    "drift_numeric_wasserstein",
    f"""WITH {_HALVES}, {cdf_sql('st', 'value')}
SELECT round(sum(coalesce(abs(f - g) * (nv - v), 0)) / greatest((SELECT stddev_pop(value) FROM st WHERE part = 'reference'), 0.001), 6) AS statistic FROM cdf""",
)
def _(spark, d):
    return drift.drift_numeric_wasserstein(halves(spark, d), "value").select(F.round("statistic", 6).alias("statistic"))


_SHARES = """cc AS (SELECT event_type AS v, count(*) FILTER (part = 'reference') AS r, count(*) FILTER (part = 'current') AS c FROM st GROUP BY 1),
sh AS (SELECT r / (SELECT CAST(sum(r) AS DOUBLE) FROM cc) AS p, c / (SELECT CAST(sum(c) AS DOUBLE) FROM cc) AS q FROM cc)"""


@query(
    "drift_categorical_js",
    f"""WITH {_HALVES}, {_SHARES} SELECT round(sqrt(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
  + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2), 6) AS statistic FROM sh""",
)
def _(spark, d):
    return drift.drift_categorical_js(halves(spark, d), "event_type").select(F.round("statistic", 6).alias("statistic"))


@query(
    "drift_categorical_chi2",
    f"""WITH {_HALVES}, {_SHARES}, e AS (SELECT c, r * (SELECT CAST(sum(c) AS DOUBLE) / sum(r) FROM cc) AS x FROM cc)
SELECT round(sum((c - x) * (c - x) / x), 6) AS statistic, CAST(count(*) - 1 AS BIGINT) AS df FROM e""",
)
def _(spark, d):
    row = drift.drift_categorical_chi2(halves(spark, d), "event_type")
    return row.select(F.round("statistic", 6).alias("statistic"), "df")


_W_RATING = f"""{cdf_sql('st', 'rating')}, w AS (
  SELECT sum(coalesce(abs(f - g) * (nv - v), 0)) / greatest((SELECT stddev_pop(rating) FROM st WHERE part = 'reference'), 0.001) AS s FROM cdf)"""
@query(
    "target_drift",
    f"WITH {_SPLIT}, {_W_RATING} SELECT 'rating' AS column_name, 'wasserstein' AS method, round(s, 6) AS score, s >= 0.1 AS drifted FROM w",
)
def _(spark, d):
    return drift.target_drift(stacked(spark, d), "rating").withColumn("score", F.round("score", 6))


def _wasserstein_sql(column: str) -> str:
    return f"""(SELECT sum(coalesce(abs(f - g) * (nv - v), 0)) FROM (
    SELECT v, lead(v) OVER (ORDER BY v) AS nv, sum(r) OVER (ORDER BY v) / (SELECT CAST(count(*) AS DOUBLE) FROM st WHERE part = 'reference') AS f,
      sum(c) OVER (ORDER BY v) / (SELECT CAST(count(*) AS DOUBLE) FROM st WHERE part = 'current') AS g
    FROM (SELECT CAST({column} AS DOUBLE) AS v, count(*) FILTER (part = 'reference') AS r, count(*) FILTER (part = 'current') AS c FROM st GROUP BY 1)))
  / greatest((SELECT stddev_pop({column}) FROM st WHERE part = 'reference'), 0.001)"""


def _js_sql(column: str) -> str:
    return f"""(SELECT sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2, 0))
  FROM (SELECT count(*) FILTER (part = 'reference') / (SELECT CAST(count(*) AS DOUBLE) FROM st WHERE part = 'reference') AS p,
    count(*) FILTER (part = 'current') / (SELECT CAST(count(*) AS DOUBLE) FROM st WHERE part = 'current') AS q FROM st GROUP BY {column}))"""


# every column of the joined ratings but ts, by which they are split
_TEXTS, _NUMBERS = ("user_id", "item_id", "brand"), ("rating", "o_key", "line")
_PER_COLUMN = f"""{_SPLIT}, per AS (SELECT s >= 0.1 AS drifted FROM (
  {" UNION ALL ".join([f"SELECT {_js_sql(c)} AS s" for c in _TEXTS] + [f"SELECT {_wasserstein_sql(c)}" for c in _NUMBERS])}))"""


@query(
    "dataset_drift",
    f"""WITH {_PER_COLUMN} SELECT CAST(count(*) AS BIGINT) AS n_columns, CAST(count(*) FILTER (drifted) AS BIGINT) AS n_drifted,
  avg(CAST(drifted AS INTEGER)) AS drift_share, avg(CAST(drifted AS INTEGER)) >= 0.5 AS dataset_drift,
  CASE WHEN avg(CAST(drifted AS INTEGER)) > 0.15 THEN 'HIGH' WHEN avg(CAST(drifted AS INTEGER)) > 0.05 THEN 'MODERATE' ELSE 'LOW' END AS level FROM per""",
)
def _(spark, d):
    return drift.dataset_drift(drift.drift_table(stacked(spark, d), [*_TEXTS, *_NUMBERS]))


@query(
    "dataset_drift_tests",
    f"""WITH {_HALVES}, {cdf_sql('st', 'value')}, s AS (SELECT max(abs(f - g)) AS d FROM cdf),
l AS (SELECT d * sqrt((SELECT CAST(sum(r) AS DOUBLE) * sum(c) / (sum(r) + sum(c)) FROM vc)) AS lam FROM s),
p AS (SELECT CASE WHEN lam < 0.2 THEN 1.0 ELSE {_KS_P} END AS p FROM l),
cc AS (SELECT event_type, count(*) FILTER (part = 'reference') AS r, count(*) FILTER (part = 'current') AS c FROM st GROUP BY 1),
e AS (SELECT sum((c - x) * (c - x) / x) AS chi2 FROM (SELECT c, r * (SELECT CAST(sum(c) AS DOUBLE) / sum(r) FROM cc) AS x FROM cc))
SELECT 'value' AS column_name, 'ks' AS method, round(p, 6) AS score, p < 0.05 AS drifted FROM p
UNION ALL SELECT 'event_type', 'chi2', round(exp(-chi2 / 2) * (1 + chi2 / 2), 6), exp(-chi2 / 2) * (1 + chi2 / 2) < 0.05 FROM e""",
)
def _(spark, d):
    """The tests instead of the distances; five event types make four degrees of freedom, a closed form."""
    return drift.drift_table(halves(spark, d), ["value", "event_type"], "test").withColumn("score", F.round("score", 6))


@query(
    "drift_level",
    "SELECT event_id, CASE WHEN value / 1000 > 0.15 THEN 'HIGH' WHEN value / 1000 > 0.05 THEN 'MODERATE' ELSE 'LOW' END AS level FROM events",
)
def _(spark, d):
    return table(spark, d, "events").select("event_id", drift.drift_level(F.col("value") / 1000).alias("level"))


@query(
    "corpus_drift",
    f"""WITH {CORPUS}, st AS (SELECT *, 'reference' AS part FROM corpus WHERE genre <> 'de' UNION ALL SELECT *, 'current' FROM corpus WHERE genre <> 'fr'),
s AS (SELECT 'genre' AS column_name, 'jensen_shannon' AS method, {_js_sql('genre')} AS s UNION ALL SELECT 'director', 'jensen_shannon', {_js_sql('director')}
  UNION ALL SELECT 'year', 'wasserstein', {_wasserstein_sql('year')} UNION ALL SELECT 'rating', 'wasserstein', {_wasserstein_sql('rating')})
SELECT column_name, method, round(s, 6) AS score, s >= 0.1 AS drifted FROM s""",
)
def _(spark, d):
    c = tables.corpus(spark, d)
    rows = drift.corpus_drift(c.where("genre <> 'de'"), c.where("genre <> 'fr'"))
    return rows.withColumn("score", F.round("score", 6))


_NULLED = "SELECT event_id, ts, user_id, event_type, CASE WHEN value > 30 THEN NULL ELSE value END AS value, props FROM events"
EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def nulled(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.withColumn("value", F.when(F.col("value") <= 30, F.col("value"))).select(*EVENT_COLUMNS)


_QUALITY = f"""ev AS ({_NULLED}), long AS (
  {" UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM ev" for c in EVENT_COLUMNS)}),
cnt AS (SELECT column_name, value, count(*) AS n FROM long GROUP BY ALL)"""


@query(
    "column_quality",
    f"""WITH {_QUALITY} SELECT column_name, CAST(sum(n) AS BIGINT) AS n_rows, CAST(coalesce(sum(n) FILTER (value IS NULL), 0) AS BIGINT) AS n_null,
  CAST(count(value) AS BIGINT) AS n_distinct, CAST(max(n) FILTER (value IS NOT NULL) AS BIGINT) AS most_common_n,
  arg_min(value, (-n, value)) FILTER (value IS NOT NULL) AS most_common,
  round(coalesce(sum(n) FILTER (value IS NULL), 0) * 100.0 / sum(n), 6) AS null_pct, count(value) <= 1 AS constant FROM cnt GROUP BY column_name""",
)
def _(spark, d):
    q = drift.column_quality(nulled(spark, d), EVENT_COLUMNS)
    return q.withColumn("null_pct", F.round("null_pct", 6))


@query(
    "numeric_quality",
    """SELECT 'l_quantity' AS column_name, min(l_quantity) AS min, max(l_quantity) AS max, round(avg(l_quantity), 6) AS mean, round(stddev(l_quantity), 6) AS std,
  quantile_cont(l_quantity, 0.25) AS q25, quantile_cont(l_quantity, 0.5) AS q50, quantile_cont(l_quantity, 0.75) AS q75 FROM lineitem
UNION ALL SELECT 'l_extendedprice', min(l_extendedprice), max(l_extendedprice), round(avg(l_extendedprice), 6), round(stddev(l_extendedprice), 6),
  round(quantile_cont(l_extendedprice, 0.25), 6), round(quantile_cont(l_extendedprice, 0.5), 6), round(quantile_cont(l_extendedprice, 0.75), 6) FROM lineitem""",
)
def _(spark, d):
    q = drift.numeric_quality(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"])
    return q.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})


@query(
    "duplicate_rows",
    f"WITH {RATINGS} SELECT CAST(sum(n - 1) AS BIGINT) AS n_duplicates FROM (SELECT count(*) AS n FROM raw_ratings GROUP BY user_id, item_id, rating)",
)
def _(spark, d):
    return drift.duplicate_rows(tables.raw_ratings(spark, d).select("user_id", "item_id", "rating"))


@query(
    "missing_alert",
    f"""WITH {_QUALITY}, q AS (SELECT column_name, coalesce(sum(n) FILTER (value IS NULL), 0) * 100.0 / sum(n) AS null_pct FROM cnt GROUP BY column_name)
SELECT column_name, round(null_pct, 6) AS null_pct FROM q WHERE null_pct > 5""",
)
def _(spark, d):
    q = drift.column_quality(nulled(spark, d), EVENT_COLUMNS)
    return drift.missing_alert(q).select("column_name", F.round("null_pct", 6).alias("null_pct"))


_LINE_NUMBERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
_CORRELATIONS = " UNION ALL ".join(
    f"SELECT '{x}' AS column_a, '{y}' AS column_b, corr({x}, {y}) FILTER (part = 'reference') AS r, corr({x}, {y}) FILTER (part = 'current') AS c FROM st"
    for x, y in combinations(_LINE_NUMBERS, 2)
)


@query(
    "correlations",
    f"""WITH st AS (SELECT *, CASE WHEN l_returnflag = 'R' THEN 'current' ELSE 'reference' END AS part FROM lineitem), c AS ({_CORRELATIONS})
SELECT column_a, column_b, round(r, 6) AS reference, round(c, 6) AS current, round(c - r, 6) AS change FROM c""",
)
def _(spark, d):
    """All columns of numbers, as the table's schema names them."""
    part = F.when(F.col("l_returnflag") == "R", "current").otherwise("reference")
    c = drift.correlations(table(spark, d, "lineitem").withColumn("part", part))
    return c.withColumns({k: F.round(k, 6) for k in ("reference", "current", "change")})


# ---- telemetry ----
@query(
    "counter_rate",
    f"""WITH {LOG} SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, endpoint, method, CAST(count(*) AS BIGINT) AS n,
  round(count(*) / 300.0, 6) AS rate FROM log GROUP BY ALL""",
)
def _(spark, d):
    r = telemetry.counter_rate(tables.request_log(spark, d), "5 minutes", ["endpoint", "method"])
    return r.withColumn("window_start", F.col("window_start").cast(NTZ)).withColumn("rate", F.round("rate", 6))


@query(
    "sliding_rate",
    f"""WITH {LOG}, steps AS (SELECT epoch(ts)::BIGINT // 60 AS s, endpoint, count(*) AS n FROM (SELECT date_trunc('second', ts) AS ts, endpoint FROM log) GROUP BY ALL)
SELECT make_timestamp((s + i) * 60 * 1000000) AS window_end, endpoint, CAST(sum(n) AS BIGINT) AS increase, round(sum(n) / 300.0, 6) AS rate
FROM steps, range(1, 6) r(i) GROUP BY ALL""",
)
def _(spark, d):
    r = telemetry.sliding_rate(tables.request_log(spark, d), "5 minutes", "1 minute", ["endpoint"])
    return r.withColumn("window_end", F.col("window_end").cast(NTZ)).withColumn("rate", F.round("rate", 6))


@query(
    "counter_increase",
    f"WITH {LOG} SELECT date_trunc('hour', ts) AS window_start, endpoint, CAST(sum(tokens) AS BIGINT) AS increase FROM log GROUP BY ALL",
)
def _(spark, d):
    r = telemetry.counter_increase(tables.request_log(spark, d), "1 hour", ["endpoint"], "tokens")
    return r.withColumn("window_start", F.col("window_start").cast(NTZ))


@query(
    "counter_increase_sliding",
    f"""WITH {LOG}, steps AS (SELECT epoch(date_trunc('hour', ts))::BIGINT // 3600 AS s, endpoint, status, count(*) AS n FROM log GROUP BY ALL)
SELECT make_timestamp((s + i) * 3600 * 1000000) AS window_end, endpoint, status, CAST(sum(n) AS BIGINT) AS increase
FROM steps, range(1, 25) r(i) GROUP BY ALL""",
)
def _(spark, d):
    r = telemetry.sliding_increase(tables.request_log(spark, d), "24 hours", "1 hour", ["endpoint", "status"])
    return r.withColumn("window_end", F.col("window_end").cast(NTZ))


@query(
    "error_ratio",
    f"""WITH {LOG} SELECT date_trunc('hour', ts) AS window_start, round(count(*) FILTER (status >= 500) / count(*), 6) AS error_ratio FROM log GROUP BY ALL""",
)
def _(spark, d):
    r = telemetry.error_ratio(tables.request_log(spark, d), "1 hour")
    return r.select(F.col("window_start").cast(NTZ).alias("window_start"), F.round("error_ratio", 6).alias("error_ratio"))


_LES = ", ".join(f"('{float(b)}', {b}::DOUBLE)" for b in BOUNDS)


def hist_sql(source: str, value: str, labels: str) -> str:
    return f"""hb AS (SELECT {labels}, le, b, CAST(count(*) FILTER ({value} <= b) AS BIGINT) AS n
  FROM {source}, (VALUES {_LES}, ('+Inf', 'Infinity'::DOUBLE)) t(le, b) GROUP BY ALL)"""


@query("histogram_buckets", f"WITH {LOG}, {hist_sql('log', 'duration', 'endpoint')} SELECT endpoint, le, n FROM hb")
def _(spark, d):
    return telemetry.histogram_buckets(tables.request_log(spark, d), "duration", BOUNDS, ["endpoint"])


@query(
    "histogram_quantile",
    f"""WITH {LOG}, {hist_sql('log', 'duration', 'endpoint')},
e AS (SELECT *, coalesce(lag(b) OVER w, 0) AS lo, coalesce(lag(n) OVER w, 0) AS below, max(n) OVER (PARTITION BY endpoint) AS total
  FROM hb WINDOW w AS (PARTITION BY endpoint ORDER BY b)),
f AS (SELECT e.*, q, row_number() OVER (PARTITION BY endpoint, q ORDER BY b) AS rn FROM e, (VALUES (0.5::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE)) t(q) WHERE n >= q * total)
SELECT endpoint, q, round(CASE WHEN isinf(b) THEN lo ELSE lo + (b - lo) * (q * total - below) / (n - below) END, 6) AS value FROM f WHERE rn = 1""",
)
def _(spark, d):
    r = telemetry.histogram_quantile(tables.request_log(spark, d), "duration", BOUNDS, labels=["endpoint"])
    return r.withColumn("value", F.round("value", 6))


@query(
    "sliding_quantile",
    f"""WITH {LOG}, steps AS (SELECT endpoint, duration, to_timestamp((CAST(floor(epoch(ts) / 60) AS BIGINT) + i) * 60)::TIMESTAMP AS window_end
  FROM log, range(1, 6) r(i)), {hist_sql('steps', 'duration', 'endpoint, window_end')},
e AS (SELECT *, coalesce(lag(b) OVER w, 0) AS lo, coalesce(lag(n) OVER w, 0) AS below, max(n) OVER (PARTITION BY endpoint, window_end) AS total
  FROM hb WINDOW w AS (PARTITION BY endpoint, window_end ORDER BY b)),
f AS (SELECT e.*, q, row_number() OVER (PARTITION BY endpoint, window_end, q ORDER BY b) AS rn
  FROM e, (VALUES (0.5::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE)) t(q) WHERE n >= q * total)
SELECT window_end, endpoint, q, round(CASE WHEN isinf(b) THEN lo ELSE lo + (b - lo) * (q * total - below) / (n - below) END, 6) AS value FROM f WHERE rn = 1""",
)
def _(spark, d):
    """The quantiles of the trailing five minutes, every minute, by endpoint."""
    r = telemetry.sliding_quantile(tables.request_log(spark, d), "duration", BOUNDS, labels=["endpoint"])
    return r.select(F.col("window_end").cast("timestamp_ntz").alias("window_end"), "endpoint", "q", F.round("value", 6).alias("value"))


@query(
    "exact_latency_percentiles",
    f"""WITH {LOG} SELECT 0.95::DOUBLE AS q, round(quantile_cont(duration, 0.95), 6) AS value FROM log
UNION ALL SELECT 0.99::DOUBLE, round(quantile_cont(duration, 0.99), 6) FROM log""",
)
def _(spark, d):
    return telemetry.exact_latency_percentiles(tables.request_log(spark, d)).withColumn("value", F.round("value", 6))


@query(
    "approx_latency_percentiles",
    f"""WITH {LOG} SELECT endpoint, 0.95::DOUBLE AS q, quantile_disc(duration, 0.95) AS value, CAST(count(*) AS BIGINT) AS n FROM log GROUP BY endpoint
UNION ALL SELECT endpoint, 0.99::DOUBLE, quantile_disc(duration, 0.99), CAST(count(*) AS BIGINT) FROM log GROUP BY endpoint""",
)
def _(spark, d):
    """Sketches of one minute, merged by endpoint; exact as long as an endpoint has no more rows than a sketch keeps."""
    sketches = telemetry.quantile_sketches(tables.request_log(spark, d), "duration", ["endpoint"])
    return telemetry.sketched_quantiles(sketches, labels=["endpoint"])


@query(
    "slo_check",
    f"""WITH {LOG}, s AS (SELECT quantile_cont(duration, 0.95) AS p, avg(CASE WHEN status >= 500 THEN 1.0 ELSE 0.0 END) AS e,
  avg(CASE WHEN status >= 400 THEN 1.0 ELSE 0.0 END) AS f FROM log)
SELECT round(p, 6) AS p95, round(e, 6) AS error_rate, round(f, 6) AS failed_rate, p < 0.5 AS p95_ok, e < 0.01 AS error_ok, f < 0.05 AS failed_ok FROM s""",
)
def _(spark, d):
    return telemetry.slo_check(tables.request_log(spark, d)).withColumns(
        {c: F.round(c, 6) for c in ("p95", "error_rate", "failed_rate")}
    )


@query("gauge_last", f"WITH {LOG} SELECT endpoint, arg_max(value, (ts, event_id)) AS value FROM log GROUP BY endpoint")
def _(spark, d):
    return telemetry.gauge_last(tables.request_log(spark, d), "value", ["endpoint"])


@query(
    "gauge_ratio",
    f"WITH {LOG} SELECT endpoint, round(arg_max(value, (ts, event_id)) / arg_max(tokens, (ts, event_id)), 6) AS ratio FROM log GROUP BY endpoint",
)
def _(spark, d):
    r = telemetry.gauge_ratio(tables.request_log(spark, d), "value", "tokens", ["endpoint"])
    return r.withColumn("ratio", F.round("ratio", 6))


@query(
    "cache_hit_ratio",
    f"""WITH {LOG} SELECT date_trunc('day', ts) AS window_start, round(count(*) FILTER (endpoint = 'view') /
  nullif(count(*) FILTER (endpoint = 'view') + count(*) FILTER (endpoint = 'click'), 0), 6) AS hit_ratio FROM log GROUP BY ALL""",
)
def _(spark, d):
    r = telemetry.cache_hit_ratio(tables.request_log(spark, d), F.col("endpoint") == "view", F.col("endpoint") == "click", "1 day")
    return r.select(F.col("window_start").cast(NTZ).alias("window_start"), F.round("hit_ratio", 6).alias("hit_ratio"))


@query("avg_by", f"WITH {LOG} SELECT endpoint, round(avg(value), 6) AS average FROM log GROUP BY endpoint")
def _(spark, d):
    return telemetry.avg_by(tables.request_log(spark, d), "value", ["endpoint"]).withColumn("average", F.round("average", 6))


@query(
    "request_log_metrics",
    f"""WITH {LOG} SELECT method, endpoint, CAST(status AS INTEGER) AS status, CAST(count(*) AS BIGINT) AS requests, round(sum(duration), 4) AS duration_sum
FROM log GROUP BY ALL""",
)
def _(spark, d):
    r = telemetry.request_log_metrics(tables.request_log(spark, d))
    return r.withColumn("duration_sum", F.round("duration_sum", 4))


@query(
    "token_usage",
    f"""WITH {LOG} SELECT 'm' || key % 3 AS model, CAST(coalesce(sum(tokens) FILTER (status < 500), 0) AS BIGINT) AS tokens,
  round(avg(tokens) FILTER (status < 500), 6) AS tokens_per_request, CAST(count(*) FILTER (status < 500) AS BIGINT) AS succeeded,
  CAST(count(*) FILTER (status >= 500) AS BIGINT) AS failed, round(coalesce(sum(tokens) FILTER (status < 500), 0) * 0.5 / 1000, 6) AS estimated_cost
FROM log GROUP BY ALL""",
)
def _(spark, d):
    log = tables.request_log(spark, d).withColumn("model", F.concat(F.lit("m"), (F.col("key") % 3).cast("string")))
    r = telemetry.token_usage(log, cost_per_1k=0.5)
    return r.withColumn("tokens_per_request", F.round("tokens_per_request", 6)).withColumn("estimated_cost", F.round("estimated_cost", 6))


MESSAGES = ["HTTP 429 Too Many", "Quota exceeded", "Rate limit hit", "401", "Unauthorized", "bad API key", "404", "Model not found", "timeout"]
_MESSAGES = ", ".join(f"'{m}'" for m in MESSAGES)


@query(
    "error_class",
    f"""WITH m AS (SELECT event_id, [{_MESSAGES}][CAST(event_id % {len(MESSAGES)} + 1 AS INTEGER)] || ' ' || props AS msg FROM events)
SELECT event_id, CASE WHEN contains(lower(msg), '429') OR contains(lower(msg), 'quota') OR contains(lower(msg), 'rate limit') THEN 'rate'
  WHEN contains(lower(msg), '401') OR contains(lower(msg), 'unauthorized') OR contains(lower(msg), 'api key') THEN 'auth'
  WHEN contains(lower(msg), '404') OR contains(lower(msg), 'not found') THEN 'model' ELSE 'other' END AS error_class FROM m""",
)
def _(spark, d):
    listed = F.array(*[F.lit(m) for m in MESSAGES])
    message = F.concat(F.get(listed, (F.col("event_id") % len(MESSAGES)).cast("int")), F.lit(" "), F.col("props"))
    return table(spark, d, "events").select("event_id", telemetry.error_class(message).alias("error_class"))


@query(
    "strategy_runs_scores",
    """WITH r AS (SELECT event_type AS strategy, 'v' || user_id % 2 AS variant, least(value / 100, 1) AS score FROM events)
SELECT strategy, variant, le, CAST(count(*) FILTER (score <= b) AS BIGINT) AS n FROM r, (VALUES
  ('0.1', 0.1::DOUBLE), ('0.2', 0.2::DOUBLE), ('0.3', 0.3::DOUBLE), ('0.4', 0.4::DOUBLE), ('0.5', 0.5::DOUBLE), ('0.6', 0.6::DOUBLE), ('0.7', 0.7::DOUBLE),
  ('0.8', 0.8::DOUBLE), ('0.9', 0.9::DOUBLE), ('1.0', 1.0::DOUBLE), ('+Inf', 'Infinity'::DOUBLE)) t(le, b) GROUP BY ALL""",
)
def _(spark, d):
    runs = table(spark, d, "events").select(
        F.col("event_type").alias("strategy"),
        F.concat(F.lit("v"), (F.col("user_id") % 2).cast("string")).alias("variant"),
        F.least(F.col("value") / 100, F.lit(1.0)).alias("score"),
    )
    return telemetry.strategy_runs_scores(runs)


# ---- quotas: the log is played 200 times faster, so that the minute windows fill ----
def fast_log(spark: SparkSession, d: str) -> DataFrame:
    start = 1_704_067_200_000_000
    e = table(spark, d, "events")
    at = F.lit(start) + F.floor((F.unix_micros(tables.instant("ts")) - start) / 200)
    return e.select(
        F.col("event_type").alias("key"), "event_id", F.timestamp_micros(at).alias("ts"), F.ceil("value").cast("long").alias("tokens")
    )


_FAST = """fast AS (SELECT event_type AS key, event_id, 1704067200000000 + CAST(floor((epoch_us(ts) - 1704067200000000) / 200.0) AS BIGINT) AS at,
  CAST(ceil(value) AS BIGINT) AS tokens FROM events),
usage AS (SELECT a.key, a.event_id, CAST(count(b.event_id) FILTER (b.at >= a.at - 60000000) AS BIGINT) AS requests_minute,
  CAST(coalesce(sum(b.tokens) FILTER (b.at >= a.at - 60000000), 0) AS BIGINT) AS tokens_minute, CAST(count(b.event_id) AS BIGINT) AS requests_day
  FROM fast a LEFT JOIN fast b ON a.key = b.key AND b.at >= a.at - 86400000000 AND (b.at < a.at OR (b.at = a.at AND b.event_id < a.event_id)) GROUP BY ALL)"""


@query("trailing_usage", f"WITH {_FAST} SELECT key, event_id, requests_minute, tokens_minute, requests_day FROM usage")
def _(spark, d):
    return quota.trailing_usage(fast_log(spark, d), bucket_seconds=600)


@query(
    "remaining_quota",
    f"""WITH {_FAST} SELECT key, event_id, greatest(0, 12 - requests_minute) AS rpm_remaining, greatest(0, 500 - tokens_minute) AS tpm_remaining,
  greatest(0, 1000 - requests_day) AS daily_remaining FROM usage""",
)
def _(spark, d):
    return quota.remaining_quota(quota.trailing_usage(fast_log(spark, d), bucket_seconds=600), 12, 500, 1000)


@query("admission_control", f"WITH RECURSIVE {LOG}, {ADMISSION} SELECT key, event_id, reason, reason = 'ok' AS admitted FROM passed WHERE rn > 0")
def _(spark, d):
    """Admission per user in event order, with limits so low (2 a minute, 60 tokens, 3 a day) that all of them block."""
    return quota.admission_control(tables.request_log(spark, d), rpm=2, tpm=60, daily=3)
