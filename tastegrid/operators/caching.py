"""Response cache as a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.operators.cleaning import first_per_key

TTL_SECONDS = 86_400


def cache_lookup(requests: DataFrame, cache: DataFrame, ttl_seconds: int = TTL_SECONDS) -> DataFrame:
    """Adds ``cached`` and the stored ``response`` to requests(cache_key, ts, …).

    ``cache`` has one row per key: cache_key, response, ts. An entry counts while it is younger than the
    time to live at the request.
    """
    entry = cache.select("cache_key", "response", F.col("ts").alias("_at"))
    age = F.unix_micros("ts") - F.unix_micros("_at")
    fresh = F.coalesce((age >= 0) & (age < ttl_seconds * 1_000_000), F.lit(False))
    return (
        requests.join(entry, "cache_key", "left")
        .withColumn("cached", fresh)
        .withColumn("response", F.when(F.col("cached"), F.col("response")))
        .drop("_at")
    )


def cache_misses(looked_up: DataFrame) -> DataFrame:
    """One row per missing key, the earliest request: the calls to make."""
    missing = looked_up.where("not cached").drop("cached", "response")
    return first_per_key(missing, ["cache_key"], ["ts", "event_id"])


def cache_refill(cache: DataFrame, answered: DataFrame) -> DataFrame:
    """Old entries plus the new answers; the newest entry of a key stays."""
    both = cache.select("cache_key", "response", "ts").unionByName(answered.select("cache_key", "response", "ts"))
    return both.groupBy("cache_key").agg(F.max_by("response", "ts").alias("response"), F.max("ts").alias("ts"))
