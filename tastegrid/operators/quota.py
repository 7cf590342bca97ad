"""Sliding quotas and admission over a request log (key, event_id, ts, tokens)."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.operators.ordering import running_totals
from tastegrid.session import settle

MINUTE, DAY = 60, 86_400
_MICROS = 1_000_000
# fixed values: default limits
RPM, TPM, DAILY = 5, 250_000, 20


def trailing_usage(log: DataFrame, bucket_seconds: int = 3600, minute: int = MINUTE, day: int = DAY) -> DataFrame:
    """Per event: requests and tokens of the key in the trailing minute and requests in the trailing day,
    counting earlier events only; an event exactly one width old still counts.

    A trailing total is the running total just before the event minus the running total just before
    (event time - width). Every event therefore adds two probe rows, and both totals come from windows
    over (key, hour) plus a small table of hourly totals: no key is collected in one place.
    """
    at = F.unix_micros("ts")
    marks = F.array(
        *[
            F.struct((at - w * _MICROS).alias("at"), F.lit(kind).alias("kind"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("t"))
            for kind, w in ((0, minute), (1, day))
        ],
        F.struct(at.alias("at"), F.lit(2).alias("kind"), F.lit(1).cast("long").alias("n"), F.col("tokens").cast("long").alias("t")),
    )
    rows = log.select("key", "event_id", F.explode(marks).alias("m")).select("key", "event_id", "m.*")
    # at one instant the probes come first: they must not see the events of that instant
    rows = rows.withColumn("late", (F.col("kind") == 2).cast("int"))
    bucket = F.floor(F.col("at") / (bucket_seconds * _MICROS))
    run = running_totals(rows, ["key"], bucket, ["at", "late", "event_id"], {"n": "cn", "t": "ct"})

    def of(kind: int, c: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col(c)))

    per_event = run.groupBy("key", "event_id").agg(
        (of(2, "cn") - 1 - of(0, "cn")).alias("requests_minute"),
        (of(2, "ct") - F.max(F.when(F.col("kind") == 2, F.col("t"))) - of(0, "ct")).alias("tokens_minute"),
        (of(2, "cn") - 1 - of(1, "cn")).alias("requests_day"),
    )
    return per_event


def remaining_quota(usage: DataFrame, rpm: int = RPM, tpm: int = TPM, daily: int = DAILY) -> DataFrame:
    """max(0, limit - used) for the three limits."""
    def left(limit: int, c: str) -> Column:
        return F.greatest(F.lit(0).cast("long"), F.lit(limit).cast("long") - F.col(c))

    return usage.select(
        "key",
        "event_id",
        left(rpm, "requests_minute").alias("rpm_remaining"),
        left(tpm, "tokens_minute").alias("tpm_remaining"),
        left(daily, "requests_day").alias("daily_remaining"),
    )


class Ledger:
    """Admitted requests of one key inside the trailing day: at most ``daily`` entries."""

    def __init__(self, rpm: int, tpm: int, daily: int, entries: list[tuple[int, int]] | None = None):
        self.rpm, self.tpm, self.daily = rpm, tpm, daily
        self.entries: deque[tuple[int, int]] = deque(entries or [])

    def decide(self, at: int, tokens: int) -> str:
        """``ok``, or the limit that blocks: daily, then rpm, then tokens."""
        while self.entries and self.entries[0][0] < at - DAY * _MICROS:
            self.entries.popleft()
        recent = [t for a, t in self.entries if a >= at - MINUTE * _MICROS]
        if len(self.entries) >= self.daily:
            return "daily"
        if len(recent) >= self.rpm:
            return "rpm"
        if sum(recent) + tokens > self.tpm:
            return "tokens"
        self.entries.append((at, tokens))
        return "ok"


def _piece(df: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """Join on (key, piece), rows without a key included; the columns of ``df``, then the rest of ``other``."""
    right = other.withColumnsRenamed({"key": "_k", "piece": "_p"})
    joined = df.join(right, F.col("key").eqNullSafe(F.col("_k")) & (F.col("piece") == F.col("_p")), how)
    return joined if how == "left_semi" else joined.drop("_k", "_p")


def _decided(rows: DataFrame, rpm: int, tpm: int, daily: int) -> DataFrame:
    """key, piece, event_id, at, tokens, reason of the events of each (key, piece), one ordered pass per piece.

    Rows with ``given`` are requests admitted at the end of the piece before: they fill the ledger and are not decided. Sorted
    batches stream through; a pass holds at most ``daily`` entries.
    """
    ordered = rows.repartition("key", "piece").sortWithinPartitions("key", "piece", "at", F.col("given").desc(), "event_id")

    def passes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ledger = None, None
        for batch in batches:
            reasons = []
            columns = [batch.column(c).to_pylist() for c in ("key", "piece", "at", "tokens", "given")]
            for key, piece, at, tokens, given in zip(*columns):
                if (key, piece) != current:
                    current, ledger = (key, piece), Ledger(rpm, tpm, daily)
                if given:
                    ledger.entries.append((at, tokens))
                reasons.append(None if given else ledger.decide(at, tokens))
            table = pa.Table.from_batches([batch]).append_column("reason", pa.array(reasons, pa.string()))
            yield from table.drop_columns(["given"]).to_batches()

    schema = ordered.drop("given").schema.add("reason", "string")
    return ordered.mapInArrow(passes, schema).where(F.col("reason").isNotNull())


def _carried(decided: DataFrame, days: int) -> DataFrame:
    """key, piece, admitted: what the ledger holds at the end of a piece, at most ``daily`` (at, event_id, tokens) in order."""
    from_here = ((F.col("piece") + 1) * days - 1) * DAY * _MICROS
    entry = F.when((F.col("reason") == "ok") & (F.col("at") >= from_here), F.struct("at", "event_id", "tokens"))
    return decided.groupBy("key", "piece").agg(F.array_sort(F.collect_list(entry)).alias("admitted"))


def admission_control(log: DataFrame, rpm: int = RPM, tpm: int = TPM, daily: int = DAILY, days: int = 7) -> DataFrame:
    """key, event_id, admitted, reason: greedy admission in event order; only admitted requests use quota.

    A decision depends on those of the trailing day, so timelines are cut into pieces of ``days`` days. First all
    pieces run as if nothing had been admitted before; then a piece runs again, with what the piece before has
    admitted in its last day, as long as that changed. A piece whose predecessor keeps those admissions is final:
    the rounds end after the longest chain of changes (a change seldom outlives a piece, since limits that leave
    slack or silences forget it), and later rounds touch only pieces in such chains. No task holds the life of a
    key, and the result does not depend on ``days``. Events of a null key share one ledger; events of one instant
    go by event_id.
    """
    at = F.unix_micros("ts")
    events = settle(
        log.select("key", F.floor(at / (days * DAY * _MICROS)).alias("piece"), F.col("event_id").cast("long").alias("event_id"), at.alias("at"), F.col("tokens").cast("long").alias("tokens"))
        .withColumn("given", F.lit(False))
        .repartition("key", "piece")
    )
    layers = [settle(_decided(events, rpm, tpm, daily).withColumn("round", F.lit(0)))]
    pieces = settle(_carried(layers[0], days).withColumn("round", F.lit(0)))
    changed = pieces.where(F.size("admitted") > 0)
    while True:
        # what a changed piece has admitted last is given to the next piece, where that has events
        todo = _piece(pieces.select("key", "piece"), changed.select("key", (F.col("piece") + 1).alias("piece")), "left_semi")
        if todo.isEmpty():
            break
        given = changed.select("key", (F.col("piece") + 1).alias("piece"), F.explode("admitted").alias("e"))
        given = given.select("key", "piece", F.col("e.event_id").alias("event_id"), F.col("e.at").alias("at"), F.col("e.tokens").alias("tokens"), F.lit(True).alias("given"))
        rows = _piece(events, todo, "left_semi").unionByName(_piece(given, todo, "left_semi"))
        turn = len(layers)
        layers.append(settle(_decided(rows, rpm, tpm, daily).withColumn("round", F.lit(turn))))
        again = _carried(layers[-1], days).withColumnRenamed("admitted", "now")
        pieces = settle(
            _piece(pieces, again, "left").select(
                "key", "piece", F.coalesce("now", "admitted").alias("admitted"),
                F.when(F.col("now").isNotNull(), turn).otherwise(F.col("round")).alias("round"),
                (F.col("now") != F.col("admitted")).alias("moved"),
            )
        )
        changed = pieces.where("moved").drop("moved")
        pieces = pieces.drop("moved")
    decided = reduce(DataFrame.unionByName, layers)
    last = _piece(decided, pieces.select("key", "piece", F.col("round").alias("last")), "inner").where(F.col("round") == F.col("last"))
    return last.select("key", "event_id", "reason", (F.col("reason") == "ok").alias("admitted"))
