"""Sharding by balanced label propagation, in DataFrame operations only.

Linked documents (here: equal texts) start in contiguous runs of their links. Each round, a join with the
counts per (link, shard) lets every linked document see how many neighbours each shard holds; it asks for
the shard with the most, and shards accept moves only up to their row quota. Documents without links are
ballast: they take what the quotas leave, so shard sizes are at most one row apart at the end.

A link that holds a third of all rows is only ever a count per shard; its rows are placed by running
counts over buckets. No pairs are formed. The driver sees one row per shard and round.

Nulls, ties and odd rows: a null text has size 1, checksum 0 and no link; equal texts are linked, empty
ones too; repeated rows are rows of their own; ties are broken by hash and row position; an empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegrid.llm.layout import digest, keyed
from tastegrid.operators.ordering import global_position, running_totals
from tastegrid.session import settle

SHARDS, ROUNDS = 16, 10
#: Rows of one window task where positions are counted.
RUN = 1 << 14


def _pick(values: list[int], index: Column) -> Column:
    """values[index]: one number per shard as an expression."""
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]), (index + 1).cast("int"))


def _dealt(position: Column, room: list[int]) -> Column:
    """The shard of a dense position where shard s takes room[s] positions."""
    shard = F.lit(len(room) - 1)
    for s in range(len(room) - 2, -1, -1):
        shard = F.when(position < sum(room[: s + 1]), F.lit(s)).otherwise(shard)
    return shard.cast("int")


def propagate(nodes: DataFrame, links: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """node, shard for dense ``node`` numbers 0..n-1 and ``links`` (node, link): rows of one link are neighbours."""
    n = nodes.count()
    quota = [n // shards + (s < n % shards) for s in range(shards)]
    shared = links.groupBy("link").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("link")
    edges = settle(links.join(shared, "link"))
    first = edges.groupBy("node").agg(F.min("link").alias("_first"))
    linked = global_position(first, ["_first", "node"], "_at")
    m = linked.count()
    start = [q * m // max(n, 1) for q in quota]
    for s in range(shards):  # the rest of the division, one each
        start[s] += s < m - sum(q * m // max(n, 1) for q in quota)
    state = settle(linked.select("node", _dealt(F.col("_at"), start).alias("shard")))
    held = _counts(state, shards)
    for _ in range(rounds):
        free = [q - h for q, h in zip(quota, held)]
        placed = edges.join(state, "node")
        counts = placed.groupBy("link", "shard").agg(F.count(F.lit(1)).alias("_c")).withColumnRenamed("shard", "_to")
        votes = (
            placed.join(counts, "link")
            .groupBy("node", "shard", "_to")
            .agg(F.sum("_c").alias("_votes"), F.max(F.xxhash64("link", "_to")).alias("_tie"), F.min("link").alias("_group"))
            .where((F.col("_to") == F.col("shard")) | (_pick(free, F.col("_to")) > 0))
        )
        best = votes.groupBy("node", "shard").agg(F.max(F.struct("_votes", "_tie", "_to", "_group")).alias("_b"))
        asks = best.where(F.col("_b._to") != F.col("shard")).select("node", F.col("_b._to").alias("_to"), F.xxhash64("_b._group").alias("_h"))
        order = running_totals(
            asks.withColumn("_one", F.lit(1)), ["_to"], F.shiftright("_h", 52), ["_h", "node"], {"_one": "_rank"}
        )
        moves = settle(order.where(F.col("_rank") <= _pick(free, F.col("_to"))).select("node", "_to"))
        if moves.isEmpty():
            break
        state = settle(state.join(moves, "node", "left").select("node", F.coalesce("_to", "shard").alias("shard")))
        held = _counts(state, shards)
    rest = global_position(nodes.select("node").join(state, "node", "left_anti"), ["node"], "_at")
    ballast = rest.select("node", _dealt(F.col("_at"), [q - h for q, h in zip(quota, held)]).alias("shard"))
    return state.unionByName(ballast)


def _counts(state: DataFrame, shards: int) -> list[int]:
    found = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def assign_shards(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, run: int = RUN) -> DataFrame:
    """doc_id, _digest, node, size, text_crc32, shard, slot: every row gets a shard and a gapless slot in it."""
    raw = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    rows = docs.select(
        "doc_id", digest(F.col("text")).alias("_digest"), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32")
    )
    nodes = settle(global_position(rows, ["doc_id", "_digest"], "node"))
    links = nodes.where(F.col("_digest").isNotNull()).select("node", F.col("_digest").alias("link"))
    placed = nodes.join(propagate(nodes, links, shards, rounds), "node")
    slots = running_totals(placed.withColumn("_one", F.lit(1)), ["shard"], F.floor(F.col("node") / run), ["node"], {"_one": "_rank"})
    return slots.withColumn("slot", (F.col("_rank") - 1).cast("long")).drop("_rank", "_one")


def with_shards(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` added (columns of these names are replaced)."""
    placed = assign_shards(docs, shards, rounds)
    own = Window.partitionBy("doc_id", "_digest").orderBy("node")
    numbered = placed.select("doc_id", "_digest", "shard", "slot", F.row_number().over(own).alias("_copy"))
    named = numbered.select(
        F.col("doc_id").alias("_id"), F.col("_digest").alias("_d"), F.col("_copy").alias("_c"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot")
    )
    rows = keyed(docs)
    on = rows["doc_id"].eqNullSafe(named["_id"]) & rows["_digest"].eqNullSafe(named["_d"]) & (rows["_copy"] == named["_c"])
    kept = [rows[c] for c in docs.columns if c not in ("shard", "slot")]
    return rows.join(named, on).select(*kept, F.col("_shard").alias("shard"), F.col("_slot").alias("slot"))
