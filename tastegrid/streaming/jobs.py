"""Streaming forms of the usage, guardrail, metric, cache and admission operators.

Each takes and gives a streaming DataFrame; the batch operator on the same rows gives the same answer
for every closed window.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tastegrid.functions import guards
from tastegrid.operators.quota import DAILY, DAY, RPM, TPM, Ledger
from tastegrid.operators.telemetry import histogram_buckets

WATERMARK = "10 minutes"


def read_table_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet table as a file stream; the schema is taken from the table itself."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # as a one-letter glob: the file source takes a plain path for a folder, a table may be one file
    parent, name = path.rsplit("/", 1)
    return reader.parquet(f"{parent}/[{name[0]}]{name[1:]}")


def run_available(stream: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Process all that is there, write to ``folder`` (exactly once, by checkpoint) and read it back."""
    sink = (
        stream.writeStream.outputMode(mode)
        .format("parquet")
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    sink.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")


def stream_usage_windows(
    log: DataFrame, width: str = "1 minute", slide: str | None = None, watermark: str = WATERMARK
) -> DataFrame:
    """Requests and tokens per key in tumbling (or sliding) event-time windows."""
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    counts = log.withWatermark("ts", watermark).groupBy(window, "key").agg(
        F.count(F.lit(1)).alias("requests"), F.sum("tokens").alias("tokens")
    )
    return counts.select(F.col("window.start").alias("window_start"), "key", "requests", "tokens")


def stream_guardrails(texts: DataFrame, text: str = "text", width: str = "1 hour", watermark: str = WATERMARK) -> DataFrame:
    """Violations by (window, guardrail_type, severity) over a stream of (ts, text)."""
    checked = texts.withWatermark("ts", watermark).select("ts", guards.validate_input(F.col(text)).alias("r"))
    found = checked.select("ts", F.explode("r.violations").alias("v"))
    counts = found.groupBy(
        F.window("ts", width), F.col("v.guardrail_type").alias("guardrail_type"), F.col("v.severity").alias("severity")
    ).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("window.start").alias("window_start"), "guardrail_type", "severity", "n")


def stream_metrics(log: DataFrame, value: str, bounds: list[float], width: str = "1 hour", watermark: str = WATERMARK) -> DataFrame:
    """Cumulative histogram buckets per (window, endpoint)."""
    windowed = log.withWatermark("ts", watermark).withColumn("w", F.window("ts", width))
    buckets = histogram_buckets(windowed, value, bounds, ["w", "endpoint"])
    return buckets.select(F.col("w.start").alias("window_start"), "endpoint", "le", "n")


def dedup_prompts(requests: DataFrame, ttl: str = "1 day") -> DataFrame:
    """The first request per cache key within the time to live."""
    return requests.withWatermark("ts", ttl).dropDuplicatesWithinWatermark(["cache_key"])


def stream_admission(
    log: DataFrame, rpm: int = RPM, tpm: int = TPM, daily: int = DAILY, watermark: str = WATERMARK
) -> DataFrame:
    """key, event_id, reason, admitted: the admission rule in event order, whatever the order of arrival.

    Events wait in the key's state until the watermark has passed them, so a late event still comes before the
    events that it precedes; what arrives behind the watermark is dropped by Spark. State per key: the waiting
    events, and the admitted instants and tokens of the trailing day, at most ``daily`` of each. It leaves memory
    a day after the key's last event. Events that the watermark has not passed yet have no decision yet.
    """
    key_type = log.schema["key"].dataType.simpleString()

    def decide(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at, tokens, waiting = state.get if state.exists else ([], [], [])
        queue = [tuple(w) for w in waiting]
        if not state.hasTimedOut:
            for rows in chunks:
                queue += zip(rows["at"].tolist(), rows["event_id"].tolist(), rows["tokens"].tolist())
        passed = state.getCurrentWatermarkMs() * 1000
        due = sorted(w for w in queue if w[0] < passed)
        queue = sorted(w for w in queue if w[0] >= passed)
        ledger = Ledger(rpm, tpm, daily, [(int(a), int(t)) for a, t in zip(at, tokens)])
        reasons = [ledger.decide(int(a), int(t)) for a, _, t in due]
        if not queue and (not ledger.entries or ledger.entries[-1][0] + DAY * 1_000_000 < passed):
            state.remove()
        else:
            state.update(([a for a, _ in ledger.entries], [t for _, t in ledger.entries], queue))
            # woken when the watermark passes the first waiting event, or a day after the last admitted one
            wake = queue[0][0] // 1000 + 1 if queue else ledger.entries[-1][0] // 1000 + DAY * 1000 + 1
            state.setTimeoutTimestamp(max(wake, state.getCurrentWatermarkMs() + 1))
        if due:
            yield pd.DataFrame(
                {
                    "key": key[0],
                    "event_id": [e for _, e, _ in due],
                    "reason": reasons,
                    "admitted": [r == "ok" for r in reasons],
                }
            )

    slim = log.withWatermark("ts", watermark).select(
        "key", "event_id", "ts", F.unix_micros("ts").alias("at"), F.col("tokens").cast("long").alias("tokens")
    )
    return slim.groupBy("key").applyInPandasWithState(
        decide,
        f"key {key_type}, event_id long, reason string, admitted boolean",
        "at array<long>, tokens array<long>, waiting array<struct<at: long, event_id: long, tokens: long>>",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
