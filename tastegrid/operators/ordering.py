"""Exact global positions and running totals without a single-task window."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, TimestampType

from tastegrid.session import settle

_LOCAL_BITS = 33
#: Order keys drawn per round of a selection; as many travel to the driver.
SELECT_SAMPLE = 16_384


def global_position(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Zero-based position of each row under ``order`` over the whole table.

    Rows are range-partitioned on the full order key, so a hot leading value is split by the later
    columns. The partition layout is written out once (range bounds are sampled, a replay could draw
    others), then only one (partition, count) row per partition goes through a window.
    """
    laid_out = settle(
        df.repartitionByRange(*[F.col(c) for c in order])
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    return _numbered(laid_out, name)


def _numbered(laid_out: DataFrame, name: str) -> DataFrame:
    """Positions of written rows with ``_mid``, a monotonically increasing id: partition by partition."""
    part = F.shiftright("_mid", _LOCAL_BITS)
    sizes = laid_out.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # one row per task of the previous stage: bounded by the partition count, safe to broadcast
    return (
        laid_out.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_mid").bitwiseAND((1 << _LOCAL_BITS) - 1))
        .drop("_part", "_mid", "_start")
    )


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[str],
    values: dict[str, str],
) -> DataFrame:
    """Inclusive running sums of ``values`` (column -> output name) per key under ``order``.

    Two phases: rows are summed inside (key, bucket) windows, and the much smaller table of bucket
    totals carries the offsets. A key that owns a third of the table is thus spread over its buckets.
    ``bucket`` must be non-decreasing along ``order``.
    """
    rows = df.withColumn("_bucket", bucket)
    totals = rows.groupBy(*keys, "_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in values])
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_bucket").alias("_ob"),
        *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_o_{c}") for c in values],
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    local = rows
    for c in values:
        local = local.withColumn(f"_l_{c}", F.sum(c).over(inside))
    # null-safe, so rows without a key stay
    same = F.col("_bucket").eqNullSafe(F.col("_ob"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = local.join(offsets, same, "inner")
    for c, out in values.items():
        joined = joined.withColumn(out, F.col(f"_l_{c}") + F.col(f"_o_{c}"))
    helper = ["_bucket", "_ob"] + [f"_k_{k}" for k in keys]
    helper += [f"_l_{c}" for c in values] + [f"_o_{c}" for c in values]
    return joined.drop(*helper)


def _spelled(column: Column, kind: DataType) -> Column:
    """A value as text that ``_literal`` turns back into the same value."""
    if isinstance(kind, TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(kind, BinaryType):
        return F.hex(column)
    return column.cast("string")


def _literal(text: str | None, kind: DataType) -> Column:
    value = F.lit(text)
    if isinstance(kind, TimestampType):
        return F.timestamp_micros(value.cast("long"))
    if isinstance(kind, BinaryType):
        return F.unhex(value)
    return value.cast(kind)


class _Keys:
    """Rows of a table between two order keys (nulls first), as predicates on its columns."""

    def __init__(self, df: DataFrame, order: Sequence[str]):
        self.order, self.kinds = list(order), [df.schema[c].dataType for c in order]
        self.key = F.struct(*[F.col(c) for c in order])

    def at(self, pivot: Sequence[str | None]) -> Column:
        return F.struct(*[_literal(v, k).alias(c) for v, k, c in zip(pivot, self.kinds, self.order)])

    def inside(self, low: Sequence[str | None] | None, high: Sequence[str | None] | None) -> Column:
        """Strictly between; the bound on the first column alone is stated too, since scans can use it."""
        first, keep = F.col(self.order[0]), F.lit(True)
        if low is not None:
            keep = keep & (self.key > self.at(low))
            if low[0] is not None:
                keep = keep & (first >= _literal(low[0], self.kinds[0]))
        if high is not None:
            keep = keep & (self.key < self.at(high))
            keep = keep & (first.isNull() if high[0] is None else first.isNull() | (first <= _literal(high[0], self.kinds[0])))
        return keep


def select_rank(df: DataFrame, order: Sequence[str], rank: int, n: int, sample: int = SELECT_SAMPLE) -> tuple[list[str | None], int]:
    """The order key of the row at zero-based ``rank`` of ``n``, spelled as text, and how many rows come before that key.

    Sampled selection: about ``sample`` keys of the rows still in question give two keys that enclose the rank
    almost surely, one scan counts the rows below, between and above them, and the search goes on where the rank
    lies. Rows in question shrink by about sqrt(sample) / 4 a round; with at most ``sample`` left, all are listed.
    Only counts and sampled keys leave the tasks: no sort, no shuffle of the table.
    """
    keys = _Keys(df, order)
    spelled = [_spelled(F.col(c), k).alias(f"k{i}") for i, (c, k) in enumerate(zip(keys.order, keys.kinds))]
    low = high = None
    before, left, seed = 0, n, 0
    while True:
        rows = df.select(*keys.order).where(keys.inside(low, high))
        drawn = (rows if left <= sample else rows.sample(fraction=sample / left, seed=seed)).orderBy(*keys.order).select(*spelled).collect()
        seed += 1
        if left <= sample:
            target = tuple(drawn[rank - before])
            return list(target), before + next(i for i, r in enumerate(drawn) if tuple(r) == target)
        if not drawn:
            continue
        share = (rank - before) / left
        reach = 2 * math.sqrt(len(drawn) * max(share * (1 - share), 1 / len(drawn))) + 1
        place = share * len(drawn)
        a = tuple(drawn[max(0, int(place - reach))])
        b = tuple(drawn[min(len(drawn) - 1, int(place + reach))])
        below, on_a, above, on_b = rows.agg(
            F.count_if(keys.key < keys.at(a)), F.count_if(keys.key == keys.at(a)), F.count_if(keys.key > keys.at(b)), F.count_if(keys.key == keys.at(b))
        ).first()
        ends = [before + below, before + below + on_a, before + left - above - (0 if a == b else on_b), before + left - above]
        if rank < ends[0]:
            high, left = a, below
        elif rank < ends[1]:
            return list(a), ends[0]
        elif rank < ends[2]:
            low, high, left, before = a, b, ends[2] - ends[1], ends[1]
        elif rank < ends[3]:
            return list(b), ends[2]
        else:
            low, left, before = b, above, ends[3]


def split_at_fraction(df: DataFrame, order: Sequence[str], fraction: float = 0.7) -> DataFrame:
    """Tag the first int(fraction * n) rows ``reference`` and the rest ``current``.

    The cut key is selected by counting (``select_rank``); each row is then compared with it where it lies, so the
    table is neither sorted nor written. Only if the cut falls among rows with the very same order key are those
    rows written out and told apart, by their place. ``df`` is read several times and has to give the same rows.
    """
    n = df.count()
    cut = int(n * fraction)
    if not 0 < cut < n:
        return df.withColumn("part", F.lit("reference" if cut else "current"))
    pivot, before = select_rank(df, order, cut, n)
    keys = _Keys(df, order)
    here, taken = keys.at(pivot), cut - before
    part = F.when(keys.key < here, "reference").otherwise("current")
    if not taken:
        return df.withColumn("part", part)
    equal = settle(df.where(keys.key == here).withColumn("_mid", F.monotonically_increasing_id()))
    placed = _numbered(equal, "_at").withColumn("part", F.when(F.col("_at") < taken, "reference").otherwise("current"))
    return df.where(keys.key != here).withColumn("part", part).unionByName(placed.drop("_at"))
