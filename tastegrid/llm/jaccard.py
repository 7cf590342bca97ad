"""N-gram Jaccard join by multiple-global-order filtering.

A document's set is its distinct word shingles. Two sets of similarity t or more share a token among the first
|x| - ceil(t |x|) + 1 of either, under any one order of all tokens. So candidates must share a prefix token
under several orders at once: rarest first (which makes the join small), and two hash orders. Under the first order
the tokens from the shared one on also bound the intersection, which must reach t / (1 + t) of both sizes. What
passes all of them is verified on the whole sets.

Steps, all spread by Spark:
 1. equal sets become one class (96 bits of sums of mixed tokens); copies never meet as pairs;
 2. tokens travel in packed blocks to their bucket, where their number of classes is counted exactly. Tokens of a
    single class can be in no intersection: they come first in every order, cost one number per class and stay.
    Tokens that are frequent already inside one task are marked in a fixed-size bitmap; they come last in every
    order and skip the buckets, so no bucket gathers a token that a third of all documents have;
 3. classes whose prefix holds shared tokens are joined on them. A short posting list gives its pairs; a long one
    (a large group of near copies) is first compared with its least changed member only, components are merged,
    and only then are pairs of members that are still apart compared. No link between different components is lost,
    and no group is expanded into all its pairs;
 4. components by iterated minimum labels with pointer jumping;
 5. where links themselves are asked for (``similarity_links``, ``n_links``), the pairs that step 3 left out are all
    formed: members of long lists are cut into blocks inside their component, a task takes two packed blocks and
    counts common tokens of all their members at once. Only counts (or, for the links, links) leave the task. The
    work grows with the square of a group of near copies, as the number of its links does.

Nulls, ties and odd rows: a null or empty text has an empty set and is its own component; a row without doc_id has
no component; rows that repeat a doc_id are linked through it only if their sets are; repeated rows give equal
results; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegrid.llm.words import distinct_per_text, groups, mix, shingle_hashes, texts_of, word_hashes
from tastegrid.operators.ordering import global_position
from tastegrid.session import settle

WIDTH, PERCENT = 5, 75
#: Tokens of a chunk inside a task; tokens of a bucket on average; classes of one chunk that make a token frequent.
CHUNK, BUCKET, FREQUENT = 2_000_000, 1_500_000, 32
#: Bits of the frequent map (fixed size) and of a token on its way.
MAP_BITS, TOKEN_BITS = 22, 48
#: Members of a posting list whose pairs are formed at once; rounds of comparing long lists with one member.
SHORT, STAR_ROUNDS = 24, 1
#: Members of a block of a component and their tokens, on average; pairs by rare tokens that are spread at once.
MEMBERS, MEMBER_TOKENS, SPREAD = 1024, 1_000_000, 1_000_000


class Sets:
    """Token sets of different classes: ``tokens`` sorted inside each class, ``after`` their bounds, two keys each."""

    def __init__(self, tokens: np.ndarray, after: np.ndarray, keys: np.ndarray | None = None):
        self.tokens, self.after = tokens, after
        self.sizes = np.diff(after)
        if keys is None:
            keys = np.stack([_sums(mix(tokens + np.uint64(seed)), after) for seed in (1, 2)], axis=1)
            keys[:, 1] >>= np.uint64(32)  # 96 bits tell classes apart and weigh less on the way
        self.keys = keys


def _sums(values: np.ndarray, after: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[after[1:]] - total[after[:-1]]


def _sets(raw: np.ndarray, bounds: np.ndarray, width: int) -> Iterator[Sets]:
    for i, j in groups(bounds):
        hashes, before, _ = word_hashes(raw, bounds[i : j + 1], True)
        tokens, after = shingle_hashes(hashes, before, width)
        yield Sets(*distinct_per_text(tokens >> np.uint64(64 - TOKEN_BITS), after))


def _chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[list[pa.RecordBatch], Sets]]:
    """(rows without their text, sets of those rows) of about CHUNK tokens; the text is the first column."""
    ids: list = []
    parts: list[Sets] = []
    held = 0

    def whole() -> Sets:
        tokens = np.concatenate([p.tokens for p in parts])
        after = np.concatenate([[0], np.cumsum(np.concatenate([p.sizes for p in parts]))])
        return Sets(tokens, after, np.concatenate([p.keys for p in parts]))

    for batch in batches:
        raw, bounds = texts_of(batch.column(0))
        rows, at = batch.select(batch.schema.names[1:]), 0
        for part in _sets(raw, bounds, width):
            n = len(part.sizes)
            ids.append(rows.slice(at, n))
            parts.append(part)
            held, at = held + len(part.tokens), at + n
            if held >= CHUNK:
                yield ids, whole()
                ids, parts, held = [], [], 0
    if parts:
        yield ids, whole()


def _distinct_classes(sets: Sets) -> np.ndarray:
    """The first row of each class that has tokens."""
    order = np.lexsort((sets.keys[:, 1], sets.keys[:, 0]))
    k = sets.keys[order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]).any(1)
    first = order[new]
    return np.sort(first[sets.sizes[first] > 0])


def _take(sets: Sets, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, owner as number in ``rows``) of some classes."""
    sizes = sets.sizes[rows]
    at = np.repeat(sets.after[rows] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    return sets.tokens[at], np.repeat(np.arange(len(rows), dtype=np.int32), sizes)


def _cell(tokens: np.ndarray) -> np.ndarray:
    return (mix(tokens) >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def _class_rows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """A row per document (doc_id, x1, x2, k1, k2, n) and a row per cell of a frequent token (cell)."""
    for rows, sets in _chunks(batches, width):
        kinds, names = rows[0].schema.types, [*rows[0].schema.names, "k1", "k2", "n", "cell"]
        own = pa.Table.from_batches(rows).combine_chunks().columns
        k = sets.keys.view(np.int64)
        mine = [*(c.chunk(0) for c in own), pa.array(k[:, 0]), pa.array(k[:, 1]), pa.array(sets.sizes), pa.nulls(len(k), pa.int64())]
        yield pa.RecordBatch.from_arrays(mine, names)
        tokens, _ = _take(sets, _distinct_classes(sets))
        different, count = np.unique(tokens, return_counts=True)
        cells = np.unique(_cell(different[count >= FREQUENT]))
        none = [pa.nulls(len(cells), t) for t in [*kinds, *[pa.int64()] * 3]]
        yield pa.RecordBatch.from_arrays([*none, pa.array(cells)], names)


# ---- packed blocks -------------------------------------------------------------------------------------------------


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte: the planes of small numbers shrink to nothing."""
    import zstandard

    width = next(w for w in (2, 4, 8) if w == 8 or not len(values) or int(values.max()) < 1 << (8 * w))
    planes = np.ascontiguousarray(values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unplanes(data: bytes) -> np.ndarray:
    import zstandard

    width = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.uint64)


def _pack(*columns: np.ndarray) -> bytes:
    parts = [_planes(c) for c in columns]
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def _unpack(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 8], "little")
        out.append(_unplanes(data[at + 8 : at + 8 + n]))
        at += 8 + n
    return out


_BLOCK = "part int, frequent boolean, block binary"


def _blocks(part: np.ndarray, parts: int, frequent: bool, keys: np.ndarray, sizes: np.ndarray, tokens, owner, df=None):
    """One row per part: the classes it concerns (keys, sizes) and their tokens, sorted, with owners."""
    order = np.argsort(tokens)
    part = part[order]
    if len(part) and (np.diff(part) < 0).any():  # buckets rise with the token, parts of classes do not
        again = np.argsort(part, kind="stable")
        order, part = order[again], part[again]
    found, firsts = np.unique(part, return_index=True)
    bounds = np.append(firsts, len(part))
    rows = []
    for k, p in enumerate(found):
        at = order[bounds[k] : bounds[k + 1]]
        own, number = np.unique(owner[at], return_inverse=True)
        steps = np.diff(tokens[at], prepend=np.uint64(0))
        more = [] if df is None else [df[at]]
        rows.append((int(p), _pack(keys[own, 0], keys[own, 1], sizes[own], steps, number, *more)))
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([frequent] * len(rows)), pa.array([r[1] for r in rows], pa.binary())],
            ["part", "frequent", "block"],
        )


def _gather(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
    """(keys, sizes, tokens, owner, df) of some blocks, their classes numbered anew."""
    keys, sizes, tokens, owner, df, n = [], [], [], [], [], 0
    for block in blocks:
        k1, k2, size, steps, number, *more = _unpack(block)
        keys.append(np.stack([k1, k2], axis=1))
        sizes.append(size.astype(np.int64))
        tokens.append(np.cumsum(steps, dtype=np.uint64))
        owner.append(number.astype(np.int32) + np.int32(n))
        df += more
        n += len(k1)
    keys, sizes, owner = np.concatenate(keys), np.concatenate(sizes), np.concatenate(owner)
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    new = np.ones(n, bool)
    new[1:] = (keys[order][1:] != keys[order][:-1]).any(1)
    number = np.empty(n, np.int32)
    number[order] = np.cumsum(new) - 1
    return keys[order][new], sizes[order][new], np.concatenate(tokens), number[owner], np.concatenate(df) if df else None


def _token_rows(batches: Iterator[pa.RecordBatch], width: int, shared, buckets: int) -> Iterator[pa.RecordBatch]:
    """Blocks of rare tokens by token bucket, and of frequent ones by the part of their class."""
    frequent = np.unpackbits(np.frombuffer(shared.value, np.uint8)).astype(bool)
    for _, sets in _chunks(batches, width):
        rows = _distinct_classes(sets)
        tokens, owner = _take(sets, rows)
        keys, sizes = sets.keys[rows], sets.sizes[rows]
        often = frequent[_cell(tokens)]
        bucket = ((tokens[~often] >> np.uint64(TOKEN_BITS - 32)) * np.uint64(buckets)) >> np.uint64(32)
        yield from _blocks(bucket.astype(np.int64), buckets, False, keys, sizes, tokens[~often], owner[~often])
        part = (keys[owner[often], 1] % np.uint64(buckets)).astype(np.int64)
        yield from _blocks(part, buckets, True, keys, sizes, tokens[often], owner[often])


def _per_group(work: Callable[..., pa.Table], **settings) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        return work(table, **settings)

    return run


def _shared_tokens(table: pa.Table, parts: int) -> pa.Table:
    """Of one bucket: the tokens of two classes at least, with their number of classes, by the part of the class.

    Blocks of frequent tokens are at their class's part already and go on as they are.
    """
    frequent = table.filter(table["frequent"])
    table = table.filter(pc.invert(table["frequent"]))
    if not table.num_rows:
        return frequent
    keys, sizes, tokens, owner, _ = _gather(table["block"].to_pylist())
    order = np.argsort(tokens)
    tokens, owner = tokens[order], owner[order]
    often = np.zeros(len(tokens), bool)  # most tokens occur once and end here
    often[1:] = tokens[1:] == tokens[:-1]
    often[:-1] |= often[1:]
    tokens, owner = tokens[often], owner[often]
    order = np.lexsort((owner, tokens))
    tokens, owner = tokens[order], owner[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])  # the same class from several tasks
    tokens, owner = tokens[new], owner[new]
    starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.zeros(0, np.int64)
    df = np.repeat(np.diff(np.append(starts, len(tokens))), np.diff(np.append(starts, len(tokens))))
    tokens, owner, df = tokens[df > 1], owner[df > 1], df[df > 1]
    part = (keys[owner, 1] % np.uint64(parts)).astype(np.int64)
    found = list(_blocks(part, parts, False, keys, sizes, tokens, owner, df.astype(np.uint64)))
    return pa.concat_tables([frequent, pa.Table.from_batches(found, frequent.schema)])


def prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    """Tokens of a set of n among which a partner must share one, under any order."""
    return n + (-percent * n // 100) + 1


_RECORD = "k1 bigint, k2 bigint, tokens binary, rare array<bigint>, second array<bigint>, third array<bigint>, shared bigint"


def _records(table: pa.Table, percent: int) -> pa.Table:
    """Of one part: every class whose prefix reaches shared tokens, with them and its prefixes under three orders."""
    often = table["frequent"].to_pylist()
    blocks = table["block"].to_pylist()
    gathered = []
    for kind in (False, True):
        own = [b for b, f in zip(blocks, often) if f == kind]
        if own:
            keys, sizes, tokens, owner, df = _gather(own)
            gathered.append((keys, sizes, tokens, owner, df if df is not None else np.full(len(tokens), 1 << 40, np.uint64)))
    keys, sizes = np.concatenate([g[0] for g in gathered]), np.concatenate([g[1] for g in gathered])
    shift = np.cumsum([0, *[len(g[0]) for g in gathered]])
    tokens, df = np.concatenate([g[2] for g in gathered]), np.concatenate([g[4] for g in gathered])
    owner = np.concatenate([g[3] + s for g, s in zip(gathered, shift)])
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    new = np.ones(len(keys), bool)
    new[1:] = (keys[order][1:] != keys[order][:-1]).any(1)
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    keys, sizes, owner = keys[order][new], sizes[order][new], number[owner]
    order = np.lexsort((tokens, owner))
    tokens, owner, df = tokens[order], owner[order], df[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    tokens, owner, df = tokens[new], owner[new], df[new]
    bounds = np.searchsorted(owner, np.arange(len(keys) + 1))
    reach = prefix_size(sizes, percent) - (sizes - np.diff(bounds))
    frequent = df >= 1 << 40
    ranks = [
        np.lexsort((tokens, df, owner)),
        np.lexsort((mix(tokens + np.uint64(11)), np.log2(df.astype(float)).astype(int), owner)),
        np.lexsort((mix(tokens + np.uint64(12)), frequent, owner)),
    ]
    chosen = np.flatnonzero(reach > 0)
    signed = tokens.astype(np.int64)
    columns: list[list] = [[], [], [], [], [], [], []]
    k = keys.view(np.int64)
    for c in chosen.tolist():
        a, b = int(bounds[c]), int(bounds[c + 1])
        r = min(int(reach[c]), b - a)
        if not r:
            continue
        columns[0].append(int(k[c, 0])), columns[1].append(int(k[c, 1])), columns[2].append(signed[a:b].tobytes())
        for out, rank in zip(columns[3:], ranks):
            out.append(signed[rank[a : a + r]])
        columns[6].append(b - a)
    kinds = [pa.int64(), pa.int64(), pa.binary(), *[pa.list_(pa.int64())] * 3, pa.int64()]
    names = ["k1", "k2", "tokens", "rare", "second", "third", "shared"]
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names)


# ---- candidates, verification, components ---------------------------------------------------------------------------


def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, na, nb, ta, tb = (batch.column(k) for k in range(6))
        keep = np.zeros(batch.num_rows, bool)
        for i in range(batch.num_rows):
            x, y = (np.frombuffer(t[i].as_buffer(), np.int64) for t in (ta, tb))
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep[i] = 100 * both >= percent * (na[i].as_py() + nb[i].as_py() - both)
        yield pa.RecordBatch.from_arrays([a.filter(pa.array(keep)), b.filter(pa.array(keep))], ["a", "b"])


def _links(pairs: DataFrame, records: DataFrame, percent: int) -> DataFrame:
    """a, b of the pairs that share a prefix token under the other orders too and are similar enough."""

    def side(name: str) -> DataFrame:
        return records.select(
            F.col("cls").alias(name), F.col("n").alias(f"n_{name}"), F.col("tokens").alias(f"t_{name}"),
            F.col("second").alias(f"s_{name}"), F.col("third").alias(f"h_{name}"),
        )

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    passed = both.where(F.arrays_overlap("s_a", "s_b") & F.arrays_overlap("h_a", "h_b"))
    return passed.select("a", "b", "n_a", "n_b", "t_a", "t_b").mapInArrow(partial(_verify, percent=percent), "a bigint, b bigint")


def components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """cls, label after merging along ``links`` (a, b): the smallest label of each component.

    Only the links between different labels take part, and they are contracted in every round: each label moves
    to its smallest neighbour, with one pointer jump, so a star is done in one round and a chain shrinks by half.
    """
    named = labels.select(F.col("cls").alias("_c"), F.col("label").alias("_l"))
    ends = links.join(named, links["a"] == named["_c"]).select("b", F.col("_l").alias("u"))
    ends = ends.join(named, ends["b"] == named["_c"]).select("u", F.col("_l").alias("v"))
    edges = settle(ends.where("u <> v").distinct())
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy(F.col("u").alias("_old")).agg(F.min(F.least("u", "v")).alias("_near"))
        jump = near.select(F.col("_old").alias("_near"), F.col("_near").alias("_next"))
        root = settle(near.join(jump, "_near", "left").select("_old", F.coalesce("_next", "_near").alias("_new")))
        labels = labels.join(root, labels["label"] == root["_old"], "left").select("cls", F.coalesce("_new", "label").alias("label"))
        left = edges.join(root, edges["u"] == root["_old"]).select(F.col("_new").alias("_u"), "v")
        right = left.join(root, left["v"] == root["_old"]).select(F.col("_u").alias("u"), F.col("_new").alias("v"))
        edges = settle(right.where("u <> v").distinct())
    return settle(labels)


def _posting_lists(records: DataFrame, percent: int) -> DataFrame:
    """token, cls, n, rest (the class's shared tokens from this one on), _n members; lists of two members at least.

    Members whose rest cannot reach the smallest member are left out: no pair of theirs passes ``_fits``.
    """
    flat = records.select("cls", "n", "shared", F.posexplode("rare").alias("_at", "token"))
    lists = flat.select("token", "cls", "n", (F.col("shared") - F.col("_at")).alias("rest"))
    least = lists.groupBy("token").agg(F.min("n").alias("_least"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    able = lists.join(least.drop("_n"), "token").where(F.col("rest") * (100 + percent) >= (F.col("n") + F.col("_least")) * percent)
    able = able.drop("_least")
    sizes = able.groupBy("token").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return settle(able.join(sizes, "token"))


def _fits(percent: int) -> Column:
    """Whether two members of a list (columns n, rest and n_h, rest_h) can be similar by sizes and positions."""
    sizes = F.least("n", "n_h") * 100 >= F.greatest("n", "n_h") * percent
    return sizes & (F.least("rest", "rest_h") * (100 + percent) >= (F.col("n") + F.col("n_h")) * percent)


def _meet(lists: DataFrame, hubs: DataFrame, percent: int, apart: bool = False) -> DataFrame:
    """a, b of the members of ``lists`` with those of ``hubs`` on the same token, each pair once."""
    other = hubs.select("token", *[F.col(c).alias(f"{c}_h") for c in ("cls", "n", "rest", *(["label"] if apart else []))])
    on = _fits(percent) & (F.col("label") != F.col("label_h") if apart else F.col("cls") != F.col("cls_h"))
    pairs = lists.join(other, "token").where(on)
    return pairs.select(F.least("cls", "cls_h").alias("a"), F.greatest("cls", "cls_h").alias("b")).distinct()


def _least_changed(lists: DataFrame) -> DataFrame:
    """One member of each list, that with the fewest tokens outside its rest (then the smallest)."""
    columns = [c for c in lists.columns if c != "token"]
    best = F.max(F.struct((F.col("rest") - F.col("n")).alias("_d"), (-F.col("cls")).alias("_o"), *columns))
    return lists.groupBy("token").agg(best.alias("_b")).select("token", *[F.col(f"_b.{c}").alias(c) for c in columns])


def _short_pairs(lists: DataFrame, percent: int) -> DataFrame:
    other = lists.select("token", *[F.col(c).alias(f"{c}_h") for c in ("cls", "n", "rest")])
    pairs = lists.join(other, "token").where((F.col("cls") < F.col("cls_h")) & _fits(percent))
    return pairs.select(F.col("cls").alias("a"), F.col("cls_h").alias("b")).distinct()


def _apart(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """The lists whose members are in more than one component, with each member's label and the largest's: main."""
    named = lists.join(labels, "cls")
    sizes = named.groupBy("token", "label").agg(F.count(F.lit(1)).alias("_m"))
    main = (
        sizes.groupBy("token")
        .agg(F.max(F.struct("_m", "label")).alias("_best"), F.count(F.lit(1)).alias("_parts"))
        .where("_parts > 1")
        .select("token", F.col("_best.label").alias("main"))
    )
    return settle(named.join(main, "token"))


# ---- all links ------------------------------------------------------------------------------------------------------


def _member_block(table: pa.Table) -> pa.Table:
    """The members of one (label, salt) as one row: their classes, sizes and tokens, sorted by token."""
    sets = [np.frombuffer(t.as_buffer(), np.int64) for t in table["tokens"].combine_chunks()]
    tokens = np.concatenate(sets).astype(np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(t) for t in sets])
    order = np.lexsort((owner, tokens))
    steps = np.diff(tokens[order], prepend=np.uint64(0))
    block = _pack(table["cls"].to_numpy(), table["n"].to_numpy(), steps, owner[order])
    return table.slice(0, 1).select(["label", "salt", "blocks"]).append_column("block", pa.array([block], pa.binary()))


def _spans(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of every run of ``n`` numbers."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _common(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many tokens each member of one block (rows) shares with each of another (columns)."""
    (own_x, own_y), shape = (x[3].astype(np.int64), y[3].astype(np.int64)), (len(x[0]), len(y[0]))
    (tokens_x, at_x, n_x), (tokens_y, at_y, n_y) = (
        np.unique(np.cumsum(b[2], dtype=np.uint64), return_index=True, return_counts=True) for b in (x, y)
    )
    _, i, j = np.intersect1d(tokens_x, tokens_y, assume_unique=True, return_indices=True)
    at_x, n_x, at_y, n_y = at_x[i], n_x[i], at_y[j], n_y[j]
    out, work = np.zeros(shape, np.int64), n_x * n_y
    often = np.flatnonzero(work * 64 > out.size)  # tokens of many members: a product of 0/1 matrices
    for first in range(0, len(often), 512):
        some = often[first : first + 512]
        dense = []
        for at, n, own, rows in ((at_x[some], n_x[some], own_x, shape[0]), (at_y[some], n_y[some], own_y, shape[1])):
            dense.append(np.zeros((rows, len(some)), np.float32))
            dense[-1][own[_spans(at, n)], np.repeat(np.arange(len(some)), n)] = 1
        out += (dense[0] @ dense[1].T).astype(np.int64)
    rare = np.flatnonzero(work * 64 <= out.size)  # the others pair by pair
    piece = np.cumsum(work[rare]) // SPREAD
    for some in np.split(rare, np.flatnonzero(np.diff(piece)) + 1):
        within = _spans(np.zeros(len(some), np.int64), work[some])
        width = np.repeat(n_y[some], work[some])
        a = own_x[np.repeat(at_x[some], work[some]) + within // width]
        b = own_y[np.repeat(at_y[some], work[some]) + within % width]
        out += np.bincount(a * shape[1] + b, minlength=out.size).reshape(shape)
    return out


def _block_pair(table: pa.Table, percent: int, count: bool) -> pa.Table:
    """Of two blocks (or one with itself): the links a, b, or with ``count`` the number of links per class."""
    blocks = [_unpack(b) for b in table["block"].to_pylist()]
    alone = table["low"][0].as_py() == table["high"][0].as_py()
    near, x, y = np.zeros((0, 0), bool), blocks[0], blocks[-1]
    if alone or len(blocks) > 1:  # a salt may have no member
        both = _common(x, y)
        n_x, n_y = x[1].astype(np.int64)[:, None], y[1].astype(np.int64)[None, :]
        near = 100 * both >= percent * (n_x + n_y - both)
        if alone:
            near = np.triu(near, 1)
    cls_x, cls_y = x[0].astype(np.int64), y[0].astype(np.int64)
    if not count:
        i, j = np.nonzero(near)
        return pa.table({"a": np.minimum(cls_x[i], cls_y[j]), "b": np.maximum(cls_x[i], cls_y[j])})
    degrees = np.concatenate([near.sum(1), near.sum(0)]).astype(np.int64)
    some = np.flatnonzero(degrees)
    return pa.table({"cls": np.concatenate([cls_x, cls_y])[some] if len(some) else np.zeros(0, np.int64), "n_links": degrees[some]})


def _block_links(records: DataFrame, labels: DataFrame, members: DataFrame, percent: int, count: bool) -> DataFrame:
    """All links between ``members`` (cls), each from one pair of blocks of its component."""
    named = members.join(labels, "cls").join(records.select("cls", "n", "tokens"), "cls")
    sizes = named.groupBy("label").agg(F.count(F.lit(1)).alias("_m"), F.sum(F.octet_length("tokens") / 8).alias("_t")).where("_m > 1")
    blocks = F.ceil(F.greatest(F.col("_m") / MEMBERS, F.col("_t") / MEMBER_TOKENS)).cast("int")
    salted = named.join(sizes.select("label", blocks.alias("blocks")), "label")
    salted = salted.withColumn("salt", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    packed = salted.groupBy("label", "salt").applyInArrow(_member_block, "label bigint, salt int, blocks int, block binary")
    other = packed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = other.select("label", F.least("salt", "_other").alias("low"), F.greatest("salt", "_other").alias("high"), "block")
    schema = "cls bigint, n_links bigint" if count else "a bigint, b bigint"
    return met.groupBy("label", "low", "high").applyInArrow(_per_group(_block_pair, percent=percent, count=count), schema)


def _other_links(links: DataFrame, members: DataFrame) -> DataFrame:
    """The links with an end outside ``members``: their tokens meet in short lists only, so they are all found."""
    for end in ("a", "b"):
        links = links.join(members.select(F.col("cls").alias(end), F.lit(True).alias(f"_{end}")), end, "left")
    return links.where("_a is null or _b is null").select("a", "b")


def similarity_links(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents: doc_id, x1, x2, n, cls, rep; classes in candidates: cls, label; links: a, b, all between classes).

    x1 and x2 are hashes of the text; with doc_id they name a row up to repetition. A group of near copies has as
    many links as pairs; they are formed when the links are read.
    """
    documents, labels, links, records, members = _spanned(docs, width, percent)
    return documents, labels, _other_links(links, members).unionAll(_block_links(records, labels, members, percent, False))


def _spanned(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """(documents, labels, links that span the components, records, cls of the members of long lists).

    A pair is missing from these links only if both ends are members of long lists.
    """
    spark = docs.sparkSession
    texts = docs.select("text", "doc_id", *_text_hashes())
    kind = docs.schema["doc_id"].dataType.simpleString()
    first = settle(
        texts.mapInArrow(
            partial(_class_rows, width=width), f"doc_id {kind}, x1 bigint, x2 bigint, k1 bigint, k2 bigint, n bigint, cell bigint"
        )
    )
    cells = [r["cell"] for r in first.where("cell is not null").select("cell").distinct().collect()]  # 2**MAP_BITS at most
    bits = np.zeros(1 << MAP_BITS, bool)
    bits[cells] = True
    shared = spark.sparkContext.broadcast(np.packbits(bits).tobytes())
    rows = first.where("cell is null").drop("cell")
    per_class = rows.where("n > 0 and doc_id is not null").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"))
    classes = global_position(per_class, ["rep", "k1", "k2"], "cls")
    total = classes.agg(F.sum("n").alias("n")).first()["n"] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET))
    blocks = texts.where("doc_id is not null").mapInArrow(partial(_token_rows, width=width, shared=shared, buckets=buckets), _BLOCK)
    counted = blocks.groupBy("part").applyInArrow(_per_group(_shared_tokens, parts=buckets), _BLOCK)
    found = counted.groupBy("part").applyInArrow(_per_group(_records, percent=percent), _RECORD)
    records = settle(found.join(classes.select("k1", "k2", "cls", "n"), ["k1", "k2"]))
    lists = _posting_lists(records, percent)
    long = lists.where(F.col("_n") > SHORT).drop("_n")
    short = lists.where(F.col("_n") <= SHORT).drop("_n")
    pairs = _short_pairs(short, percent).union(_meet(long, _least_changed(long), percent)).distinct()
    links = settle(_links(pairs, records, percent))
    labels = components(records.select("cls", F.col("cls").alias("label")), links)
    for turn in range(STAR_ROUNDS + 1):
        apart = _apart(long, labels)
        if apart.isEmpty():
            break
        # outside the list's largest component: its least changed member meets all others, and at the end, as the
        # exact rest, each member does
        others = apart.where("label <> main")
        hubs = _least_changed(others) if turn < STAR_ROUNDS else others
        new = settle(_links(_meet(apart, hubs, percent, apart=True), records, percent))
        links = links.union(new)
        labels = components(labels, new)
    named = classes.select("k1", "k2", "cls", "rep").withColumnsRenamed({"k1": "_k1", "k2": "_k2"})
    own = (rows["k1"] == named["_k1"]) & (rows["k2"] == named["_k2"]) & rows["doc_id"].isNotNull()
    documents = rows.join(named, own, "left").drop("_k1", "_k2")
    return documents, labels, links.distinct(), records, long.select("cls").distinct()


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, count: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links: the smallest doc_id reachable by links, the links of the text's class.

    n_links counts all classes (different sets of shingles) that are similar enough to the document's own. Without
    ``count`` there is no n_links, and links are only looked for as far as components need them.
    """
    rows, labels, links, records, members = _spanned(docs, width, percent)
    named, columns = _named(rows, labels), ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    if not count:
        return named.select(*columns)
    others = _other_links(links, members).select(F.explode(F.array("a", "b")).alias("cls"), F.lit(1).cast("long").alias("n_links"))
    ends = others.unionAll(_block_links(records, labels, members, percent, True))
    degree = ends.groupBy("cls").agg(F.sum("n_links").alias("n_links"))
    return named.join(degree, "cls", "left").select(*columns, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def _named(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds component_id: the smallest doc_id of the class's component, its own doc_id without a class."""
    reps = rows.where("cls is not null").groupBy(F.col("cls").alias("label")).agg(F.first("rep").alias("component"))
    merged = labels.where("cls <> label").join(reps, "label").select("cls", "component")
    named = rows.join(merged, "cls", "left")
    return named.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id")))


def _text_hashes() -> list[Column]:
    return [F.coalesce(F.xxhash64(F.lit(seed), F.col("text")), F.lit(0)).alias(f"x{seed}") for seed in (1, 2)]


def keep_one(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row of each component, that with the smallest doc_id (then text hash); all columns as they came.

    Rows without a set (no words) and rows without a doc_id are linked with nothing and stay.
    """
    rows, labels, *_ = _spanned(docs, width, percent)
    named = rows.join(labels, "cls", "left").withColumn("_group", F.coalesce("label", "cls"))
    kept = (
        named.where("cls is not null")
        .groupBy("_group")
        .agg(F.min(F.struct("doc_id", "x1", "x2")).alias("_k"))
        .select("_k.*", F.lit(True).alias("_first"))
    )
    free = named.where("cls is null").select("doc_id", "x1", "x2").distinct().withColumn("_first", F.lit(False))
    fate = kept.unionByName(free).select(F.col("doc_id").alias("_id"), F.col("x1").alias("_x1"), F.col("x2").alias("_x2"), "_first")
    keys = [c.alias(f"_t{i}") for i, c in enumerate(_text_hashes(), 1)]
    marked = docs.select("*", *keys)
    both = marked.join(
        fate, marked["doc_id"].eqNullSafe(fate["_id"]) & (marked["_t1"] == fate["_x1"]) & (marked["_t2"] == fate["_x2"])
    )
    copy = F.row_number().over(Window.partitionBy("_id", "_t1", "_t2").orderBy(F.lit(0)))
    return both.withColumn("_copy", copy).where("not _first or _copy = 1").select(*[marked[c] for c in docs.columns])
