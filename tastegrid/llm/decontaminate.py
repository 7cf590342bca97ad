"""Benchmark decontamination by greedy string tiling.

Texts and benchmark items are sequences of words (runs of letters, digits and non-ASCII bytes, A-Z folded;
each character of an unspaced script such as Chinese, Japanese or Thai is a word).
Karp-Rabin hashes of ``seed`` words running over both sides are joined; a document meets only the items it
shares a seed with. For each such pair the longest match outside earlier ones is marked as a tile, again and
again, until no match of ``seed`` words is left. Tiles may come in any order, so reordered passages are
caught; a document is contaminated by an item if its tiles cover at least ``cover`` of the item's words.

The benchmark travels to the documents, so no text is shuffled and no pairs are formed in a shuffle. Its size
is checked: it goes in blocks of at most ``block_words`` words, and a larger benchmark takes more passes.

Nulls, ties and odd rows: a null or empty text matches nothing; an item of fewer than ``seed`` words has no
tile and matches a text only as a whole; of equally long matches the first in the document, then in the item, is
marked; repeated rows give repeated rows; an empty table on either side gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.words import GROUP_BYTES, groups, letters_and_digits, shingle_hashes, texts_of, word_hashes
from tastegrid.operators.ordering import running_totals
from tastegrid.session import settle

#: Words of the shortest tile; least share of an item's words; words of benchmark text that travel at once.
SEED, COVER, BLOCK_WORDS = 5, 0.5, 2_000_000
#: Places in an item that a seed may have on average where shared seeds are listed; an odd multiplier of hashes.
LISTED, BASE = 16, 0x9E3779B97F4A7C15


class Items:
    """A block of the benchmark: word hashes of its items and an index of their seeds."""

    def __init__(self, ids: list, texts: pa.Array, seed: int):
        raw, bounds = texts_of(texts)
        made = [word_hashes(raw, bounds[i : j + 1], True, letters_and_digits(), True) for i, j in groups(bounds)]
        words = [h[b[k] : b[k + 1]] for h, b, _ in made for k in range(len(b) - 1)]
        self.ids, self.words, self.seed = ids, words, seed
        self.sizes = np.array([len(w) for w in words], dtype=np.int64)
        some = [k for k in range(len(words)) if len(words[k])]
        seeds = [shingle_hashes(words[k], np.array([0, len(words[k])]), seed)[0] for k in some]
        owner = np.repeat(np.array(some, dtype=np.int64), [len(s) for s in seeds])
        place = np.concatenate([np.arange(len(s)) for s in seeds]) if seeds else np.zeros(0, np.int64)
        keys = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
        order = np.argsort(keys, kind="stable")  # inside a key by item, then by place
        keys, self.place = keys[order], place[order]
        owner = owner[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        self.first = np.flatnonzero(new)
        self.keys, self.owner = keys[self.first], owner[self.first]
        self.times = np.diff(np.append(self.first, len(keys)))
        self.bits = np.zeros(1 << 20, bool)  # most seeds of a document end here
        self.bits[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``seeds``, entry of the index) of every shared seed, once per item that has it."""
        at = np.flatnonzero(self.bits[(seeds >> np.uint64(44)).astype(np.int64)])
        first = np.searchsorted(self.keys, seeds[at], side="left")
        n = np.searchsorted(self.keys, seeds[at], side="right") - first
        at, first, n = at[n > 0], first[n > 0], n[n > 0]
        return np.repeat(at, n), np.repeat(first, n) + _within(n)

    def places(self, at: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same with every place of the seed in the item."""
        n = self.times[entry]
        return np.repeat(at, n), self.place[np.repeat(self.first[entry], n) + _within(n)]


def _within(n: np.ndarray) -> np.ndarray:
    """0 .. n[0] - 1, 0 .. n[1] - 1, ..."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def tiles_by_length(document: np.ndarray, item: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """The same tiles as ``tiles`` by running Karp-Rabin over the unmarked words with falling match lengths.

    For words that repeat on both sides, where shared seeds are as many as the product of both lengths: the
    longest common length is found by halving, all windows of one length at a time. Memory is linear.
    """
    sides, free = (document, item), [np.zeros(len(document) + 1, np.int64), np.zeros(len(item) + 1, np.int64)]
    longest = max(map(len, sides))
    powers = np.full(longest + 1, np.uint64(BASE))
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    back = np.full(longest + 1, np.uint64(pow(BASE, -1, 1 << 64)))
    back[0] = 1
    back = np.multiply.accumulate(back)
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(s * powers[: len(s)], dtype=np.uint64)]) for s in sides]
    out: list[tuple[int, int, int]] = []

    def windows(side: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the unmarked windows of one side, and their hashes."""
        n = len(sides[side]) - length + 1
        at = np.flatnonzero(free[side][length:] == free[side][:n]) if n > 0 else np.zeros(0, np.int64)
        return at, (sums[side][at + length] - sums[side][at]) * back[at]

    def common(length: int) -> tuple[int, int] | None:
        """The first match of a length: first in the document, then in the item."""
        (i, x), (j, y) = windows(0, length), windows(1, length)
        both = np.isin(x, y)
        if not both.any():
            return None
        k = int(np.argmax(both))
        return int(i[k]), int(j[int(np.argmax(y == x[k]))])

    most = min(map(len, sides))
    while most >= seed:
        low, high, found = seed, most, None
        while low <= high:
            mid = (low + high) // 2
            if (match := common(mid)) is None:
                high = mid - 1
            else:
                low, found = mid + 1, match
        most = high
        while found is not None and most >= seed:
            out.append((*found, most))
            for side, start in zip(free, found):
                side[start + 1 : start + most + 1] += np.arange(1, most + 1)
                side[start + most + 1 :] += most
            found = common(most)
        most -= 1
    return out


def tiles(at: np.ndarray, place: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """(start in the document, start in the item, words) of the tiles, from the pair's shared seeds."""
    diagonal = at - place
    order = np.lexsort((at, diagonal))
    at, place, diagonal = at[order], place[order], diagonal[order]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(diagonal) != 0) | (np.diff(at) != 1)
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(at))) + seed - 1
    heap = [(-int(n), int(i), int(j)) for n, i, j in zip(length, at[first], place[first])]
    heapify(heap)
    in_document: set[int] = set()
    in_item: set[int] = set()
    out = []
    while heap:
        n, i, j = heappop(heap)
        free = [i + k not in in_document and j + k not in in_item for k in range(-n)]
        if all(free):
            out.append((i, j, -n))
            in_document.update(range(i, i - n))
            in_item.update(range(j, j - n))
            continue
        start = None
        for k, ok in enumerate([*free, False]):  # what is left of a match between marked words
            if ok and start is None:
                start = k
            elif not ok and start is not None:
                if k - start >= seed:
                    heappush(heap, (start - k, i + start, j + start))
                start = None
    return out


def matches(raw: np.ndarray, bounds: np.ndarray, items: Items, cover: float) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, tiles, words in tiles, longest tile) of the contaminated pairs."""
    for i, j in groups(bounds, GROUP_BYTES):
        hashes, before, _ = word_hashes(raw, bounds[i : j + 1], True, letters_and_digits(), True)
        seeds, after = shingle_hashes(hashes, before, items.seed)
        at, entry = items.hits(seeds)
        pair = (np.searchsorted(after, at, side="right") - 1) * (len(items.ids) + 1) + items.owner[entry]
        order = np.argsort(pair, kind="stable")
        at, entry, pair = at[order], entry[order], pair[order]
        cuts = np.flatnonzero(np.diff(pair, prepend=-1))
        for first, last in zip(cuts, [*cuts[1:], len(pair)]):
            t, m = divmod(int(pair[first]), len(items.ids) + 1)
            own, at_item = at[first:last] - int(after[t]), entry[first:last]
            size = int(items.sizes[m])
            if size < items.seed:  # the whole item is the whole text
                yield i + t, m, 1, size, size
                continue
            if items.times[at_item].sum() > LISTED * len(own):
                found = tiles_by_length(hashes[before[t] : before[t + 1]], items.words[m], items.seed)
            else:
                own, place = items.places(own, at_item)
                # no tile reaches a word of the item outside its shared seeds
                if len(np.unique(place)) * items.seed < cover * size:
                    continue
                found = tiles(own, place, items.seed)
            words = sum(n for _, _, n in found)
            if found and words >= cover * size:
                yield i + t, m, len(found), words, max(n for _, _, n in found)


def _match_rows(batches: Iterator[pa.RecordBatch], shared, cover: float) -> Iterator[pa.RecordBatch]:
    items = shared.value
    for batch in batches:
        rows = list(matches(*texts_of(batch.column(1)), items, cover))
        text, item, n, words, longest = (np.array(c, dtype=np.int64) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 5
        size = items.sizes[item]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(text)), pa.array([items.ids[k] for k in item.tolist()], pa.int64()), pa.array(n),
                pa.array(words), pa.array(size), pa.array(longest), pa.array(words / np.maximum(size, 1)),
            ],
            ["doc_id", "item_id", "n_tiles", "tile_words", "item_words", "longest_tile", "coverage"],
        )


def _blocks(benchmark: DataFrame, seed: int, block_words: int):
    """The benchmark in broadcasts of at most ``block_words`` words (or one longer item)."""
    spark = benchmark.sparkSession
    sized = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), "text", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"\S+")).alias("_n")
    )
    total = sized.agg(F.sum("_n").alias("n")).first()["n"] or 0
    if total <= block_words:
        parts = [sized]
    else:
        line = settle(running_totals(sized, [], F.xxhash64("item_id") % 64, ["item_id", "text"], {"_n": "_end"}))
        parts = [line.where(F.floor((F.col("_end") - 1) / block_words) == b) for b in range(-(-total // block_words))]
    for part in parts:
        table = part.select("item_id", "text").toArrow()
        yield spark.sparkContext.broadcast(Items(table["item_id"].to_pylist(), table["text"].combine_chunks(), seed))


def contaminated_pairs(
    docs: DataFrame, benchmark: DataFrame, seed: int = SEED, cover: float = COVER, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """doc_id, item_id, n_tiles, tile_words, item_words, longest_tile, coverage of every contaminated pair."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id bigint, n_tiles bigint, tile_words bigint, item_words bigint, longest_tile bigint, coverage double"
    rows = docs.select("doc_id", "text")
    parts = [rows.mapInArrow(partial(_match_rows, shared=b, cover=cover), schema) for b in _blocks(benchmark, seed, block_words)]
    return reduce(DataFrame.unionAll, parts)


def _clean(batches: Iterator[pa.RecordBatch], shared: list, cover: float, at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = np.ones(batch.num_rows, bool)
        for block in shared:
            for text, *_ in matches(*texts_of(batch.column(at)), block.value, cover):
                keep[text] = False
        yield batch.filter(pa.array(keep))


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, seed: int = SEED, cover: float = COVER, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, all columns as they came."""
    out = docs
    for block in _blocks(benchmark, seed, block_words):
        out = out.mapInArrow(partial(_clean, shared=[block], cover=cover, at=docs.columns.index("text")), docs.schema)
    return out
