"""Conversation prefix trie: adaptive radix trees over fixed-width big-endian turn ids, one per task and chunk.

A turn's id is 16 bytes of a hash of role and text. The ids of up to ``SPAN`` turns of a conversation, behind a
head that names the place in the conversation and all turns before it, are one key; a task puts the keys of about
``CHUNK`` turns into a tree (``art.Tree``), and each turn-aligned byte depth of the tree gives one row. A tree thus
adds up what conversations have in common before anything is shuffled: a first turn or a whole conversation that
a third of the table shares leaves a task as one row a chunk. Rows of the same prefix are added by a shuffle.

A prefix is named by a sum of hashes of (turn id, position) modulo 2**128, so the head of a later key is a running
total, and no task walks a long conversation from its start.

Subtrees need no walk either. A node is owned by its smallest member, and the nodes that a conversation owns are
the last stretch of its path. So a sum over the different nodes below v is a sum over members of v, and a second
pass of trees, over the conversations that own a node, adds it up.

Ids of the conversations that end at a node are sorted, packed and hashed as a stream: a hash of a list reads
the list in order, so the list of one node is one pass over packed pieces, without being held.

Nulls, ties and odd rows: rows without a conv_id belong to no conversation; a null turn comes first; turns with
the same number are ordered by their ids; null role or text is empty; repeated rows are turns of their own; extra
columns are not read; a table without conversations has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.art import Tree
from tastegrid.operators.ordering import running_totals
from tastegrid.session import settle

#: Bytes of a turn id and of a key's head (block, two hash sums); turns of one key; turns of one tree.
ID, HEAD, SPAN, CHUNK = 16, 20, 64, 1 << 15
#: Bits of turn number, position or conv_id that rows of one window, join or packed piece share.
RUN_BITS, PIECE_BITS, ASK_BITS = 10, 14, 12
#: Turns taken from the base conversation, and how many conversations share one.
MOST_TAKEN, FAMILY = 6, 100
_WIDE = 1 << 64

COUNTED = (
    "na bigint, nb bigint, depth bigint, pa bigint, pb bigint, n bigint, owner bigint, chars bigint, after bigint, ends array<bigint>"
)
SUMMED = "na bigint, nb bigint, depth bigint, distinct_chars bigint, n_leaves bigint, n_children bigint"
NODE = ["na", "nb", "depth"]
ARRAYS = ("ids", "lengths", "marks_1", "marks_2")


def ordered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), id, chars of every turn; positions of a long conversation are counted in runs."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    name = F.concat(F.length(role), F.lit(":"), role, text)
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.substring(F.sha2(F.encode(name, "UTF-8"), 256), 1, 2 * ID)).alias("id"),
        F.length(text).cast("long").alias("chars"),
        F.lit(1).alias("_one"),
    )
    run = F.coalesce(F.shiftright("turn", RUN_BITS), F.lit(-(1 << 62)))
    placed = running_totals(rows, ["conv_id"], run, ["turn", "id"], {"_one": "_at"})
    return placed.select("conv_id", (F.col("_at") - 1).cast("long").alias("pos"), "id", "chars")


def rebuilt_turns(ordered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations: conv_id, len; turns: conv_id, len, d from 1, id, chars) after the exchange of first turns.

    A conversation takes its first turns, as many as a checksum of its id says, from the first one of its
    hundred, and keeps its own turns behind as many of its own.
    """
    sizes = ordered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    taken = F.when(first == F.col("conv_id"), 0).otherwise(F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % MOST_TAKEN)
    convs = sizes.withColumn("first", first).withColumn("h", taken)
    bases = sizes.select(F.col("conv_id").alias("first"), F.col("n").alias("_there"))
    convs = convs.join(bases, "first", "left")
    convs = convs.withColumn("taken", F.least(F.col("h"), F.coalesce("_there", F.lit(0))))
    convs = settle(convs.select("conv_id", "n", "first", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")))
    # at most 99 conversations ask for the five turns of one base
    asks = convs.where("taken > 0").select(F.col("conv_id").alias("_to"), F.col("first").alias("conv_id"), "taken", "len")
    heads = ordered.where(F.col("pos") < MOST_TAKEN).join(asks, "conv_id").where("pos < taken")
    heads = heads.select(F.col("_to").alias("conv_id"), "len", (F.col("pos") + 1).alias("d"), "id", "chars")
    runs = convs.select("conv_id", "h", "taken", "len", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("n") - 1, RUN_BITS))).alias("_run"))
    own = ordered.withColumn("_run", F.shiftright("pos", RUN_BITS)).join(runs, ["conv_id", "_run"]).where("pos >= h")
    own = own.select("conv_id", "len", (F.col("pos") - F.col("h") + F.col("taken") + 1).alias("d"), "id", "chars")
    return convs.select("conv_id", "len"), heads.unionByName(own)


def _part(name: str) -> Callable[[Column], Column]:
    return lambda turn: turn[name]


def _low(c: Column) -> Column:
    return c.bitwiseAND(F.lit(0xFFFFFFFF))


def keys_of(turns: DataFrame) -> DataFrame:
    """conv_id, block, len, ARRAYS (one entry a turn, in order), before (hash sums in halves) and after (characters).

    One row per SPAN turns of a conversation, written out.
    """
    one = turns.withColumn("m1", F.xxhash64("id", "d")).withColumn("m2", F.xxhash64(F.lit(1), "id", "d"))
    halves = {}
    for m in ("m1", "m2"):
        halves[f"_{m}l"], halves[f"_{m}h"] = F.sum(_low(F.col(m))), F.sum(F.shiftrightunsigned(m, 32))
    cut = one.groupBy("conv_id", F.shiftright(F.col("d") - 1, SPAN.bit_length() - 1).alias("block")).agg(
        F.max("len").alias("len"),
        F.sort_array(F.collect_list(F.struct("d", "id", "chars", "m1", "m2"))).alias("_t"),
        F.sum("chars").alias("_own"),
        *[v.alias(k) for k, v in halves.items()],
    )
    cut = settle(cut)
    # only conversations of more than one key have something before or behind
    several = cut.where(F.col("len") > SPAN).select("conv_id", "block", "_own", *halves).withColumn("_back", -F.col("block"))
    upto = running_totals(several, ["conv_id"], F.shiftright("block", RUN_BITS), ["block"], {k: f"_upto{k}" for k in halves})
    both = running_totals(upto, ["conv_id"], -F.shiftright("block", RUN_BITS), ["_back"], {"_own": "_after"})
    both = both.select("conv_id", "block", "_after", *[(F.col(f"_upto{k}") - F.col(k)).alias(f"_before{k}") for k in halves])
    joined = cut.join(both, ["conv_id", "block"], "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        "conv_id", "block", "len",
        *[F.transform("_t", _part(c)).alias(name) for c, name in zip(("id", "chars", "m1", "m2"), ARRAYS)],
        F.array(*[F.coalesce(F.col(f"_before{k}"), zero) for k in halves]).alias("before"),
        F.coalesce("_after", "_own").alias("after"),
    )


@dataclass(slots=True)
class Run:
    """The turns of one key: which conversation, prefix names and characters before each turn."""

    conv: int
    base: int
    size: int
    names: list
    upto: list
    after: int
    ends: bool
    length: int
    since: int = 0
    owned: int = 0
    leaf: int = 0


def _signed(v: int) -> int:
    return v - _WIDE if v >= _WIDE >> 1 else v


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[bytes, Run]]:
    rows = batch.to_pydict()
    extra = zip(rows["since"], rows["owned"], rows["leaf"]) if "since" in rows else None
    for conv, block, length, ids, chars, m1s, m2s, before, after in zip(
        *(rows[c] for c in ("conv_id", "block", "len", *ARRAYS, "before", "after"))
    ):
        a, b = ((before[2 * i] + (before[2 * i + 1] << 32)) % _WIDE for i in range(2))
        key = b"".join((block.to_bytes(HEAD - 16, "big"), a.to_bytes(8, "big"), b.to_bytes(8, "big"), *ids))
        names, upto = [(_signed(a), _signed(b))], [0]
        for m1, m2, c in zip(m1s, m2s, chars):
            a, b = (a + m1) % _WIDE, (b + m2) % _WIDE
            names.append((_signed(a), _signed(b)))
            upto.append(upto[-1] + c)
        base = block * SPAN
        run = Run(conv, base, len(ids), names, upto, after, base + len(ids) == length, length)
        if extra is not None:
            run.since, run.owned, run.leaf = next(extra)
        yield key, run


def _columns(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.strip().split(" ") for f in schema.split(",")]
    kinds = [pa.list_(pa.int64()) if k.startswith("array") else pa.int64() for _, k in fields]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [n for n, _ in fields])


def _trees(batches: Iterator[pa.RecordBatch], told, schema: str) -> Iterator[pa.RecordBatch]:
    """Fills a tree with about CHUNK turns at a time and gives the rows that ``told`` makes of it."""
    tree, held = Tree(), 0
    for batch in batches:
        for key, run in _runs(batch):
            tree.insert(key, run)
            held += run.size
            if held >= CHUNK:
                yield _columns(told(tree), schema)
                tree, held = Tree(), 0
    if held:
        yield _columns(told(tree), schema)


def _counted(tree: Tree) -> list[tuple]:
    """One row per prefix: how many conversations, the smallest, characters behind, and those that end."""
    out = []

    def rise(state, k, ended):
        run, n, owner, after = state
        ends = [e.conv for e in ended if e.ends]
        out.append((*run.names[k], run.base + k, *run.names[k - 1], n, owner, run.upto[k] - run.upto[k - 1], after - n * run.upto[k - 1], ends))
        return state

    tree.fold(
        HEAD, ID,
        begin=lambda run: (run, 1, run.conv, run.after),
        merge=lambda x, y: (x[0], x[1] + y[1], min(x[2], y[2]), x[3] + y[3]),
        rise=rise,
    )
    return out


def _summed(tree: Tree) -> list[tuple]:
    """One row per prefix: characters of different nodes, leaves and children, as far as the tree's runs own them."""
    out = []

    def begin(run):
        last = run.base + run.size
        if run.since <= last:  # run, the owner or None, characters and nodes owned below, leaves
            return run, run, 0, 0, run.leaf
        return run, None, run.owned, int(run.since == last + 1), run.leaf

    def merge(x, y):
        return x[0], x[1] or y[1], x[2] + y[2], x[3] + y[3], x[4] + y[4]

    def rise(state, k, ended):
        run, owner, owned, born, leaves = state
        depth = run.base + k
        mine, on = (owner.after - owner.upto[k - 1], int(owner.length > depth)) if owner else (0, 0)
        out.append((*run.names[k], depth, owned + mine, leaves, born + on))
        if owner and owner.since == depth:
            return run, None, owned + owner.owned, 1, leaves
        return run, owner, owned, 0, leaves

    tree.fold(HEAD, ID, begin, merge, rise)
    return out


def _count_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _trees(batches, _counted, COUNTED)


def _sum_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _trees(batches, _summed, SUMMED)


def _stream_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, which arrive in order; only the running hash is held."""
    now, hashed = None, None
    for batch in batches:
        out = []
        for *node, piece in zip(*(batch.column(c).to_pylist() for c in (*NODE, "piece"))):
            if node != now:
                if now is not None:
                    out.append((*now, hashed.hexdigest()))
                now, hashed = node, hashlib.sha256()
            else:
                hashed.update(b",")
            hashed.update(piece.encode())
        yield _hash_rows(out)
    if now is not None:
        yield _hash_rows([(*now, hashed.hexdigest())])


def _hash_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 4
    kinds = [pa.int64()] * 3 + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [*NODE, "ends_sha256"])


def _hashed_ends(ends: DataFrame) -> DataFrame:
    """na, nb, depth, ends_sha256 of rows na, nb, depth, conv_id."""
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda v: v.cast("string"))
    packed = ends.groupBy(*NODE, F.shiftright("conv_id", PIECE_BITS).alias("_at")).agg(F.array_join(ids, ",").alias("piece"))
    lined = packed.repartition(*[F.col(c) for c in NODE]).sortWithinPartitions(*NODE, "_at")
    return lined.select(*NODE, "piece").mapInArrow(_stream_hashes, "na bigint, nb bigint, depth bigint, ends_sha256 string")


def _parents_owners(own: DataFrame, nodes: DataFrame) -> DataFrame:
    """owner, depth, parent_conv_id of the first owned node of each owner below depth 1.

    A prefix with very many children is asked for once per bucket of children, not once per child.
    """
    asks = own.where("since > 1").select("owner", "since", "pa", "pb", F.pmod(F.xxhash64("owner"), F.lit(1 << ASK_BITS)).alias("_b"))
    asked = asks.groupBy("pa", "pb", (F.col("since") - 1).alias("depth"), "_b").agg(F.count(F.lit(1)).alias("_n"))
    there = nodes.select(F.col("na").alias("pa"), F.col("nb").alias("pb"), "depth", F.col("owner").alias("parent_conv_id"))
    answers = asked.join(there, ["pa", "pb", "depth"]).select("pa", "pb", (F.col("depth") + 1).alias("since"), "_b", "parent_conv_id")
    return asks.join(answers, ["pa", "pb", "since", "_b"]).select("owner", F.col("since").alias("depth"), "parent_conv_id")


def prefix_nodes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 per different prefix.

    ``convs``: conv_id, len; ``turns``: conv_id, len, d from 1, id, chars, one row per turn of a conversation.
    """
    keys = keys_of(turns)
    counted = settle(keys.mapInArrow(_count_trees, COUNTED))
    nodes = settle(
        counted.groupBy(*NODE).agg(
            F.min("pa").alias("pa"), F.min("pb").alias("pb"), F.sum("n").alias("n_convs"), F.min("owner").alias("owner"),
            F.max("chars").alias("chars"), F.sum("after").alias("after"), F.sum(F.size("ends")).alias("n_ends"),
        )
    )
    own = nodes.groupBy("owner").agg(
        F.min("depth").alias("since"), F.max("depth").alias("_last"), F.sum("chars").alias("owned"),
        F.max_by((F.col("n_convs") == F.col("n_ends")).cast("long"), "depth").alias("leaf"),
        F.min_by("pa", "depth").alias("pa"), F.min_by("pb", "depth").alias("pb"),
    )
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("_last") - 1, SPAN.bit_length() - 1)))
    owners = own.select(F.col("owner").alias("conv_id"), "since", "owned", "leaf", blocks.alias("block"))
    sums = keys.join(owners, ["conv_id", "block"]).mapInArrow(_sum_trees, SUMMED)
    sums = sums.groupBy(*NODE).agg(*[F.sum(c).alias(c) for c in ("distinct_chars", "n_leaves", "n_children")])
    made = nodes.join(sums, NODE).select(
        *NODE, "owner", "n_convs", "n_children", "n_leaves", (F.col("after") - F.col("distinct_chars")).alias("saved_tokens")
    )
    whole = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least")).first()
    root = _root(made, nodes, whole["n"], whole["least"])
    turnless = convs.where("len = 0").select(*[F.lit(0).cast("long").alias(c) for c in NODE], "conv_id")
    ends = counted.select(*NODE, F.explode("ends").alias("conv_id")).unionByName(turnless)
    tops = _parents_owners(own, nodes)
    named = made.unionByName(root).join(_hashed_ends(ends), NODE, "left").join(tops, ["owner", "depth"], "left")
    above = (
        F.when(F.col("depth") == 0, F.lit(None).cast("long"))
        .when(F.col("parent_conv_id").isNotNull(), F.col("parent_conv_id"))
        .when(F.col("depth") == 1, F.lit(whole["least"]).cast("long"))
        .otherwise(F.col("owner"))
    )
    return named.select(
        F.col("owner").alias("conv_id"), "depth", above.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def _root(made: DataFrame, nodes: DataFrame, n: int, least: int | None) -> DataFrame:
    """The textless root: one row, none where there is no conversation."""
    leaf = (F.col("n_convs") == F.col("n_ends")).cast("long")
    total = nodes.agg(
        F.sum((F.col("depth") == 1).cast("long")).alias("kids"), F.sum((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        F.sum(F.when(F.col("depth") > 0, leaf)).alias("leaves"),
    ).first()
    row = (0, 0, 0, least, n, total["kids"] or 0, total["leaves"] or 1, total["saved"] or 0)
    return made.sparkSession.createDataFrame([row] if n else [], made.schema)


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations as they are."""
    ordered = settle(ordered_turns(turns))
    sizes = settle(ordered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("len")))
    runs = sizes.select("conv_id", "len", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("len") - 1, RUN_BITS))).alias("_run"))
    placed = ordered.withColumn("_run", F.shiftright("pos", RUN_BITS)).join(runs, ["conv_id", "_run"])
    return prefix_nodes(sizes, placed.select("conv_id", "len", (F.col("pos") + 1).alias("d"), "id", "chars"))


def rebuilt_trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of rebuilt conversations."""
    convs, rebuilt = rebuilt_turns(settle(ordered_turns(turns)))
    return prefix_nodes(convs, rebuilt)
