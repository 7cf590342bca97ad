import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastegrid.operators import drift, quantiles, quota, telemetry
from tastegrid.plans import monitoring

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "key string, event_id long, ts timestamp, tokens long"


def log(spark, n=400, keys=3, seconds=4000, seed=1):
    rng = random.Random(seed)
    rows = [(f"k{min(rng.randrange(keys * 2), keys - 1)}", i, T0 + dt.timedelta(seconds=rng.randrange(seconds)), rng.randrange(1, 50)) for i in range(n)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_rows_to_split_are_joined_once(spark, tmp_path):
    """The split reads its rows several times; the join below them is not worked out each time."""
    rows = 30
    spark.range(rows).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey", "date_add(DATE'2024-01-01', CAST(id AS INT)) AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(rows).selectExpr("id AS l_orderkey", "id % 5 AS l_partkey", "1 AS l_linenumber", "CAST(id AS DOUBLE) AS l_quantity").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(4).selectExpr("id AS p_partkey", "concat('b', id) AS p_brand").write.parquet(f"{tmp_path}/part.parquet")
    split = monitoring.stacked(spark, str(tmp_path))
    assert "Join" not in split._jdf.queryExecution().optimizedPlan().toString()
    parts = {r[0]: r[1] for r in split.groupBy("part").count().collect()}
    assert parts == {"reference": 16, "current": 8}  # a part is missing


def test_trailing_usage_against_brute_force(spark):
    rows, df = log(spark)
    got = {r["event_id"]: r for r in quota.trailing_usage(df, bucket_seconds=300, minute=60, day=600).collect()}
    for k, i, ts, _ in rows:
        before = [r for r in rows if r[0] == k and (r[2], r[1]) < (ts, i)]
        minute = [r for r in before if r[2] >= ts - dt.timedelta(seconds=60)]
        assert got[i]["requests_minute"] == len(minute)
        assert got[i]["tokens_minute"] == sum(r[3] for r in minute)
        assert got[i]["requests_day"] == sum(r[2] >= ts - dt.timedelta(seconds=600) for r in before)


def admit(rows, rpm, tpm, daily):
    """Direct reading of the rule, one key at a time."""
    out, kept = {}, {}
    for k, i, ts, t in sorted(rows, key=lambda r: (r[2], r[1])):
        mine = kept.setdefault(k, [])
        minute = [x for x in mine if x[0] >= ts - dt.timedelta(seconds=60)]
        day = [x for x in mine if x[0] >= ts - dt.timedelta(days=1)]
        if len(day) >= daily:
            out[i] = "daily"
        elif len(minute) >= rpm:
            out[i] = "rpm"
        elif sum(x[1] for x in minute) + t > tpm:
            out[i] = "tokens"
        else:
            out[i] = "ok"
            mine.append((ts, t))
    return out


@pytest.mark.parametrize("limits", [(5, 1000, 20), (2, 60, 10_000), (3, 70, 40)])
def test_admission_against_brute_force(spark, limits):
    rows, df = log(spark, 600, seconds=400_000, seed=5)
    more, df2 = log(spark, 300, seconds=900, seed=6)
    shifted = [(k, i + 1000, ts, t) for k, i, ts, t in more]
    both = df.unionByName(df2.withColumn("event_id", F.col("event_id") + 1000))
    got = {r["event_id"]: r["reason"] for r in quota.admission_control(both, *limits).collect()}
    assert got == admit(rows + shifted, *limits)


def test_quota_example(spark):
    rows = [("a", 1, T0, 100), ("a", 2, T0 + dt.timedelta(seconds=1), 100), ("a", 3, T0 + dt.timedelta(seconds=60), 100), ("a", 4, T0 + dt.timedelta(seconds=62), 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["event_id"]: r["reason"] for r in quota.admission_control(df, 2, 1000, 20).collect()}
    assert got == {1: "ok", 2: "ok", 3: "rpm", 4: "ok"}  # an entry exactly 60 s old still counts
    left = {r["event_id"]: r for r in quota.remaining_quota(quota.trailing_usage(df), 5, 1000, 20).collect()}
    assert (left[1]["rpm_remaining"], left[1]["daily_remaining"]) == (5, 20)
    assert (left[2]["rpm_remaining"], left[2]["daily_remaining"]) == (4, 19)


def test_percentiles_with_a_hot_value(spark):
    rng = np.random.default_rng(2)
    v = np.concatenate([np.full(100, 3.0), rng.normal(size=250)])
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    got = {r["q"]: r["value"] for r in quantiles.exact_percentiles(df, "v", [0.0, 0.1, 0.5, 0.95, 1.0]).collect()}
    for q, x in got.items():
        assert x == pytest.approx(np.quantile(v, q))


def two(spark, a, b):
    rows = [(float(x), "reference") for x in a] + [(float(x), "current") for x in b]
    return spark.createDataFrame(rows, "v double, part string")


def test_ks_and_wasserstein_against_brute_force(spark):
    rng = np.random.default_rng(4)
    a, b = np.round(rng.normal(size=300), 2), np.round(rng.normal(0.4, 1, size=200), 2)
    grid = np.unique(np.concatenate([a, b]))
    f = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    g = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    df = two(spark, a, b)
    ks = drift.drift_numeric_ks(df, "v").first()
    assert ks["statistic"] == pytest.approx(np.abs(f - g).max())
    lam = ks["statistic"] * np.sqrt(300 * 200 / 500)
    series = 2 * sum((-1) ** (j - 1) * np.exp(-2 * j * j * lam * lam) for j in range(1, 101))
    assert ks["p_value"] == pytest.approx(series)
    w = drift.drift_numeric_wasserstein(df, "v").first()["statistic"]
    assert w == pytest.approx((np.abs(f - g)[:-1] * np.diff(grid)).sum() / a.std())
    same = drift.drift_numeric_ks(two(spark, a, a), "v").first()
    assert same["statistic"] == 0 and same["p_value"] == 1


def test_chi_square_tail():
    # tabulated 5 % points
    for df, x in ((1, 3.841459), (4, 9.487729), (10, 18.307038), (30, 43.772972)):
        assert drift._chi2_tail(x, df) == pytest.approx(0.05, abs=1e-6)
    assert drift._chi2_tail(float("inf"), 3) == 0.0


def test_categorical(spark):
    rows = [("a", "reference")] * 60 + [("b", "reference")] * 40 + [("a", "current")] * 20 + [("b", "current")] * 30
    df = spark.createDataFrame(rows, "c string, part string")
    chi = drift.drift_categorical_chi2(df, "c").first()
    assert chi["statistic"] == pytest.approx(100 / 30 + 100 / 20)
    assert drift.drift_categorical_js(df, "c").first()["statistic"] > 0
    table = drift.drift_table(df, ["c"], "test")
    assert table.first()["method"] == "chi2" and table.first()["drifted"]
    assert drift.dataset_drift(table).first()["level"] == "HIGH"


def test_histogram_quantile_edges(spark):
    bounds = [1.0, 2.0, 4.0]
    df = spark.createDataFrame([(0.5,), (1.5,), (3.0,), (9.0,)], "v double")
    got = {r["q"]: r["value"] for r in telemetry.histogram_quantile(df, "v", bounds, [0.25, 0.5, 0.75, 0.99]).collect()}
    assert got == {0.25: 1.0, 0.5: 2.0, 0.75: 4.0, 0.99: 4.0}  # overflow: the last finite bound


def test_sliding_equals_direct(spark):
    rows, df = log(spark, 200)
    got = {(r["window_end"], r["key"]): r["increase"] for r in telemetry.sliding_increase(df, "5 minutes", "1 minute", ["key"]).collect()}
    for (end, key), n in got.items():
        assert n == sum(r[0] == key and end - dt.timedelta(minutes=5) <= r[2] < end for r in rows)


def test_rows_without_a_key_stay(spark):
    rows = [(None, 1, T0, 5), (None, 2, T0 + dt.timedelta(seconds=5), 7), ("a", 3, T0, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    used = {r["event_id"]: r["tokens_minute"] for r in quota.trailing_usage(df).collect()}
    assert used == {1: 0, 2: 5, 3: 0}
    assert quota.admission_control(df).count() == 3


@pytest.mark.parametrize("side", ["reference", "current"])
def test_drift_with_an_empty_side_is_null(spark, side):
    one = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "x double, c string").withColumn("part", F.lit(side))
    for row in (drift.drift_numeric_ks(one, "x"), drift.drift_categorical_chi2(one, "c")):
        assert row.first()["statistic"] is None and row.first()["p_value"] is None
    assert drift.drift_numeric_wasserstein(one, "x").first()["statistic"] is None
    assert drift.drift_categorical_js(one, "c").first()["statistic"] is None
    for measure in ("distance", "test"):
        rows = drift.drift_table(one, ["x", "c"], measure).collect()
        assert [(r["score"], r["drifted"]) for r in rows] == [(None, False)] * 2


def test_the_measure_is_the_callers_choice(spark):
    small = spark.createDataFrame([(float(i), "reference" if i < 6 else "current") for i in range(10)], "x double, part string")
    assert drift.drift_table(small, ["x"]).first()["method"] == "wasserstein"
    assert drift.drift_table(small, ["x"], "test").first()["method"] == "ks"


def test_sketched_quantiles_stay_within_their_bound(spark):
    """Merged sketches of steps, for the whole log and for windows, against exact ranks."""
    n, k = 60_000, 400
    log = spark.range(n, numPartitions=8).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 1800).alias("ts"),
        F.when(F.col("id") % 997 != 0, F.pmod(F.hash("id"), F.lit(100_000)).cast("double")).alias("v"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5)).alias("key"),
    )
    sketches = telemetry.quantile_sketches(log, "v", ["key"], k=k)
    values = {}
    for r in log.where("v is not null").collect():
        values.setdefault(r["key"], []).append((r["ts"].timestamp(), r["v"]))
    whole = telemetry.sketched_quantiles(sketches, (0.5, 0.95, 0.99), ["key"], k=k).collect()
    assert len(whole) == 3 * len(values)
    for r in whole:
        own = [v for _, v in values[r["key"]]]
        assert r["n"] == len(own)
        assert abs(sum(v <= r["value"] for v in own) / len(own) - r["q"]) < 3 / k
    ends = telemetry.sketched_quantiles(sketches, (0.9,), ["key"], width="5 minutes", k=k).collect()
    for r in ends[::40]:
        end = r["window_end"].timestamp()
        own = [v for t, v in values[r["key"]] if end - 300 <= t < end]
        assert r["n"] == len(own) and abs(sum(v <= r["value"] for v in own) / len(own) - 0.9) < 3 / k + 1 / len(own)
    assert telemetry.sketched_quantiles(telemetry.quantile_sketches(log.where("v < 0"), "v")).collect() == []


def test_admission_over_many_days_without_a_silence(spark):
    """A key is busy for twelve days in four pieces, so a change in the first may travel through all; null keys count too."""
    rng = random.Random(8)
    rows = [(None if i % 5 == 0 else 1, i, T0 + dt.timedelta(seconds=rng.randrange(12 * 86_400)), rng.randrange(1, 50)) for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA.replace("key string", "key int"))
    got = quota.admission_control(df, 3, 70, 7, days=3).collect()
    assert len(got) == 900 and {r["event_id"]: r["reason"] for r in got} == admit(rows, 3, 70, 7)
    assert quota.admission_control(df.where("key = 2")).count() == 0
    burst = [("a", i, T0 + dt.timedelta(days=3 * (i // 4), seconds=i), 60) for i in range(12)]  # at the cuts, across silences
    got = quota.admission_control(spark.createDataFrame(burst, SCHEMA), 2, 100, 3, days=1).collect()
    assert {r["event_id"]: r["reason"] for r in got} == admit(burst, 2, 100, 3)
