"""Exact inner-product top-k between two vector tables.

One kernel serves document search, similar items, keyword points and collaborative scoring. Spark lays out the
work; only the best k rows of a block leave a task, and pairs are never written out. Three routes give the same rows:

- a query batch of checked size travels to the scan of the documents;
- documents of checked size travel in waves (``WAVE_BYTES`` each) to the scan of the queries, so no query is copied.
  A task holds an index of one wave (``_Wave``): dense vectors in chunks of falling norm, of which the rest is left
  out once no query can gain from it, or, where their norms are about equal, in cells of equal signs (``_Cells``), of
  which a query meets only those whose signs it shares enough of; and for sparse vectors one posting list per slot,
  read from the heaviest slot on until the slots that are left cannot lift a new document among the best k;
- sparse queries of checked size travel in waves to the scan of the documents, where those have many more numbers
  (asked for by name); a task keeps the k best of its partition;
- beyond that, queries and documents meet block by block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegrid.session import gathered, settle, spread, written

LEFT_BLOCK = 2048
RIGHT_BLOCK = 8192
QUERY_BATCH_ROWS = 4096  # a query batch up to this size may travel to the scan
QUERY_BATCH_BYTES = 32 << 20
QUERY_TASK_ROWS = 32768  # queries of a task that indexes a wave, about, where there are more tasks than cores
WAVE_BYTES, MOST_WAVES = 64 << 20, 32  # documents that travel at once, and how often
LIST_NUMBERS = 2 << 20  # weights of sparse documents that a task indexes at once
PIECE_BYTES = 16 << 20  # documents that are with the driver at once
CHUNK = 2048  # documents of one norm chunk
STEP = 512  # queries that meet a chunk at once
CELL, FEWEST = 48, 4096  # documents of a cell of equal signs, about, and of a wave that has such cells
NEAREST, MOST_MET = 4, 0.8  # outer cells that a query meets first, and the part of all documents it may have to meet
PAIR_NUMBERS = 4 << 20  # numbers of candidate pairs that are worked out at once
# vectors up to this norm are compared in single precision first, whose rounding adds at most so much a term
LARGEST_NARROW, ROUGH = 1e15, 2.0**-23
_DIGITS = 9  # scores are rounded here before ranking, so ties are ties in every layout


# fixed values: id types and what they are in Arrow
_ARROW = {
    "bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8(), "string": pa.string(),
}


def arrow_type(spark_type: str) -> pa.DataType:
    """The Arrow type of an id column."""
    if spark_type not in _ARROW:
        raise TypeError(f"ids must be one of {', '.join(_ARROW)}, not {spark_type}")
    return _ARROW[spark_type]


class _Vectors:
    """Rows of an ``array<double>`` column, or of struct<dense, slots, weights> (a dense head and a sparse tail)."""

    def __init__(self, column: pa.ChunkedArray | pa.Array):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        self.n = len(column)
        self.rows = self.slots = np.zeros(0, dtype=np.int64)
        self.weights = np.zeros(0)
        dense = column
        if pa.types.is_struct(column.type):
            dense, slots, weights = (column.field(i) for i in range(3))
            self.rows = np.repeat(np.arange(self.n), slots.value_lengths().to_numpy(zero_copy_only=False))
            self.slots = slots.flatten().to_numpy(zero_copy_only=False)
            self.weights = weights.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
        lengths = dense.value_lengths().to_numpy(zero_copy_only=False)
        if self.n and (lengths != lengths[0]).any():
            raise ValueError(f"vectors of different lengths: {sorted(set(lengths.tolist()))}")
        flat = dense.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
        self.dense = flat.reshape(self.n, -1) if len(flat) else np.zeros((self.n, 0))

    def with_slots(self, shared: np.ndarray) -> np.ndarray:
        """Dense rows with one more column per shared slot."""
        if not len(shared):
            return self.dense
        tail = np.zeros((self.n, len(shared)))
        at = np.minimum(np.searchsorted(shared, self.slots), len(shared) - 1)
        kept = shared[at] == self.slots
        tail[self.rows[kept], at[kept]] = self.weights[kept]
        return np.hstack([self.dense, tail])


def _aligned(a: _Vectors, b: _Vectors) -> tuple[np.ndarray, np.ndarray]:
    """Two matrices over the same columns; a sparse slot only one side has cannot add to a product."""
    if a.dense.shape[1] != b.dense.shape[1]:
        raise ValueError(f"vectors of different lengths: {a.dense.shape[1]} and {b.dense.shape[1]}")
    shared = np.intersect1d(a.slots, b.slots)
    return a.with_slots(shared), b.with_slots(shared)


def _ids(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.asarray(column.to_pylist(), dtype=object if pa.types.is_string(column.type) else None)


def _sorted_places(ids: np.ndarray) -> np.ndarray:
    """The stable order of ids; strings are sorted by Arrow, whose byte order is that of code points."""
    if ids.dtype != object:
        return np.argsort(ids, kind="stable")
    return pc.sort_indices(pa.array(ids, pa.string())).to_numpy(zero_copy_only=False).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row-wise (column index, score) of the k best, ties by id. ``ids`` must be sorted ascending."""
    n = scores.shape[1]
    k = min(k, n)
    if k == n:
        order = np.argsort(-scores, axis=1, kind="stable")
    else:
        kth = np.partition(scores, n - k, axis=1)[:, n - k]
        order = np.empty((scores.shape[0], k), dtype=np.int64)
        for r in range(scores.shape[0]):  # all rows tied at the k-th score compete, the lowest ids win
            keep = np.flatnonzero(scores[r] >= kth[r])
            order[r] = keep[np.argsort(-scores[r, keep], kind="stable")[:k]]
    return order, np.take_along_axis(scores, order, axis=1)


def _merge(partial: DataFrame, left_id: str, right_id: str, k: int) -> DataFrame:
    w = Window.partitionBy(left_id).orderBy(F.desc("score"), F.asc(right_id))
    if "_lo" not in partial.columns:
        return partial.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    # a group has k rows per block of documents
    whole = Window.partitionBy(left_id)
    wide = partial.withColumn("min_score", F.min("_lo").over(whole)).withColumn("max_score", F.max("_hi").over(whole))
    return wide.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).drop("_lo", "_hi")


def _blocks(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def block_pairs(
    left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_block: int, right_block: int
) -> tuple[DataFrame, DataFrame, int, int]:
    """Tag both sides with (lb, rb) block numbers so that every block pair meets in one group.

    Blocks come from a hash of the unique row id, so they stay even; each left row is sent once per right
    block and the other way round, which is the cost of an exact scan, and no group exceeds the block sizes
    (up to hash spread).
    """
    nl, nr = _blocks(left.count(), left_block), _blocks(right.count(), right_block)
    own_l = F.pmod(F.xxhash64(left_id), F.lit(nl)).cast("int")
    own_r = F.pmod(F.xxhash64(right_id), F.lit(nr)).cast("int")
    every_r = F.explode(F.sequence(F.lit(0), F.lit(nr - 1)))
    every_l = F.explode(F.sequence(F.lit(0), F.lit(nl - 1)))
    return (
        left.withColumn("_lb", own_l).withColumn("_rb", every_r),
        right.withColumn("_rb", own_r).withColumn("_lb", every_l),
        nl,
        nr,
    )


class _Wave:
    """An index of one wave of documents, sorted by id so that ties are decided by position."""

    def __init__(self, ids: np.ndarray, vectors: _Vectors, ranked: np.ndarray | None = None):
        order = _sorted_places(ids)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.ids, self.order, self.dense = ids[order], order, vectors.dense
        self.ranked = None if ranked is None or ranked.all() else ranked[order]
        rows = place[vectors.rows]
        mixed = self.dense.shape[1] > 0
        by_row = np.lexsort((vectors.slots, rows)) if mixed else np.argsort(rows, kind="stable")
        if mixed and len(rows):  # a slot that a tail names twice counts once
            a, b = rows[by_row], vectors.slots[by_row]
            by_row = by_row[np.append((a[1:] != a[:-1]) | (b[1:] != b[:-1]), True)]
        rows, row_slots, self.row_weights = rows[by_row], vectors.slots[by_row], vectors.weights[by_row]
        self.row_starts = np.searchsorted(rows, np.arange(len(ids) + 1))
        by_slot = np.argsort(row_slots, kind="stable")
        self.slots, starts = np.unique(row_slots[by_slot], return_index=True)
        self.starts = np.append(starts, len(by_slot))
        self.lengths = np.diff(self.starts)
        self.docs, self.weights = rows[by_slot], self.row_weights[by_slot]
        self.row_entries = np.empty(len(by_slot), np.int64)
        self.row_entries[by_slot] = np.repeat(np.arange(len(self.slots)), self.lengths)
        self.asked, self.seen = np.zeros(len(self.slots)), np.zeros(len(ids), bool)
        # what a slot can add at most and at least: its heaviest and lightest weight, 0 for documents without it
        bounds = self.starts[:-1]
        self.most = np.maximum(np.maximum.reduceat(self.weights, bounds), 0.0) if len(self.slots) else np.zeros(0)
        self.least = np.minimum(np.minimum.reduceat(self.weights, bounds), 0.0) if len(self.slots) else np.zeros(0)
        norms = np.sqrt(np.einsum("ij,ij->i", self.dense, self.dense))[order]
        self.kind = self._kinds() if mixed and len(self.slots) else None
        self.norms = norms
        self.scored = 0  # products and candidates that were worked out

    @cached_property
    def every(self) -> list[tuple[np.ndarray, np.ndarray, float]]:
        return self._chunks(self.norms, None)

    @cached_property
    def chunks(self) -> list[tuple[np.ndarray, np.ndarray, float]]:
        return self.every if self.ranked is None else self._chunks(self.norms, self.ranked)

    @cached_property
    def cells(self) -> _Cells | None:
        """Cells of the ranked documents, or None where there are few or their norms differ."""
        finite = np.isfinite(self.norms)
        places = np.flatnonzero(finite if self.ranked is None else finite & self.ranked)
        if len(places) < FEWEST or self.kind is not None:
            return None
        norms = self.norms[places]
        if norms.max() > LARGEST_NARROW or np.median(norms) < 0.9 * norms.max():
            return None
        return _Cells(self.dense, self.order[places], places, float(norms.max()))

    def _kinds(self) -> np.ndarray:
        """The number of each document's tail among the different tails; those are indexed by slot."""
        seen: dict[bytes, int] = {}
        kind, first = np.empty(len(self.ids), np.int64), []
        for i, (a, b) in enumerate(zip(self.row_starts[:-1].tolist(), self.row_starts[1:].tolist())):
            kind[i] = seen.setdefault(self.row_entries[a:b].tobytes() + self.row_weights[a:b].tobytes(), len(seen))
            if kind[i] == len(first):
                first.append(i)
        kept = np.isin(self.docs, first)
        self.kind_lists = kind[self.docs[kept]], self.weights[kept]
        self.kind_starts = np.searchsorted(np.flatnonzero(kept), self.starts)
        self.n_kinds = len(first)
        return kind

    def contents(self, tails: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray | None:
        """Products of the queries' tails with every different tail."""
        if self.kind is None:
            return None
        out = np.zeros((len(tails), self.n_kinds))
        kinds, own = self.kind_lists
        for row, (entries, weights) in zip(out, tails):
            for a, b, w in zip(self.kind_starts[entries].tolist(), self.kind_starts[entries + 1].tolist(), weights.tolist()):
                row[kinds[a:b]] += w * own[a:b]
        return out

    def _chunks(self, norms: np.ndarray, chosen: np.ndarray | None) -> list[tuple[np.ndarray, np.ndarray, float]]:
        """(places, their heads in single precision, longest head) of chunks of falling norm."""
        falling = np.argsort(-norms, kind="stable")
        falling = falling[np.isfinite(norms[falling])]
        if chosen is not None:
            falling = falling[chosen[falling]]
        cuts = [np.sort(falling[at : at + CHUNK]) for at in range(0, len(falling), CHUNK)]
        wide = len(falling) and norms[falling[0]] > LARGEST_NARROW
        kind = np.float64 if wide else np.float32
        return [(c, self.dense[self.order[c]].astype(kind), float(norms[c].max())) for c in cuts]

    def tails(self, queries: _Vectors) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query the index entries of its slots that some document has, and its weights."""
        return list(self.each_tail(queries))

    def each_tail(self, queries: _Vectors) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``tails`` one after another, for many queries."""
        cuts = np.searchsorted(queries.rows, np.arange(queries.n + 1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            slots, weights = queries.slots[a:b], queries.weights[a:b]
            at = np.minimum(np.searchsorted(self.slots, slots), max(len(self.slots) - 1, 0))
            kept = self.slots[at] == slots if len(self.slots) else np.zeros(len(slots), bool)
            yield at[kept], weights[kept]

    def list_of(self, entry: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.starts[entry], self.starts[entry + 1]
        return self.docs[a:b], self.weights[a:b]

    def head_best(
        self, heads: np.ndarray, content: np.ndarray | None, search: _Search, own: np.ndarray, k: int, chunks: list
    ) -> tuple[np.ndarray, np.ndarray]:
        """(positions, scores) of the k best by chunks of falling norm; ``own`` is each query's own position or -1.

        Products in single precision tell which documents can be among the k best; only those are worked out in
        double precision and ranked. ``content`` has the products of the tails, one column per different tail.
        """
        n = len(heads)
        scores, places = np.full((n, k), -np.inf), np.full((n, k), len(self.ids), np.int64)
        norms = np.sqrt(np.einsum("ij,ij->i", heads, heads))
        narrow = heads if len(norms) and not norms.max() <= LARGEST_NARROW else heads.astype(np.float32)
        lift, rough_content = np.zeros(n), None
        # a tie at the k-th place may still be decided by the id, so only smaller bounds are left out
        slack = np.full(n, 2 * 10.0**-search.digits if search.digits is not None else 0.0)
        if content is not None:
            lift, rough_content = content.max(axis=1), content.astype(narrow.dtype)
            slack += np.abs(content).max(axis=1) * ROUGH * 4
        for chunk, block, longest in chunks:
            open_ = np.flatnonzero(norms * longest + lift + slack >= scores[:, k - 1])
            if not len(open_):
                break
            rough = narrow[open_] @ block.T
            self.scored += rough.size
            doubt = (norms[open_] * longest + np.abs(lift[open_])) * ROUGH * (heads.shape[1] + 4) + slack[open_]
            floor = scores[open_, k - 1] - doubt
            if search.min_score is not None:
                floor = np.maximum(floor, search.min_score - doubt)
            hot = np.flatnonzero(rough.max(axis=1) >= floor - lift[open_])
            if not len(hot):
                continue
            rough, floor, row = rough[hot], floor[hot], open_[hot]
            fresh = np.flatnonzero(np.isneginf(scores[row, k - 1]))
            at = len(chunk) - k - 1  # one of them may be the query itself
            whole = rough_content is None or len(fresh)
            if len(fresh) and rough_content is not None:
                rough += rough_content[row][:, self.kind[chunk]]
            if len(fresh) and at > 0:
                low = np.partition(rough[fresh], at, axis=1)[:, at]
                floor[fresh] = np.maximum(floor[fresh], low - 2 * doubt[hot[fresh]])
            found, col = np.divmod(_spots(rough >= (floor if whole else floor - lift[row])[:, None]), len(chunk))
            if not whole:  # few heads are left, so only their tails are looked up
                kept = rough[found, col] + rough_content[row[found], self.kind[chunk[col]]] >= floor[found]
                found, col = found[kept], col[kept]
            found = row[found]
            step = max(1, PAIR_NUMBERS // max(1, heads.shape[1]))
            for first in range(0, len(found), step):
                part = slice(first, first + step)
                self._ranked_in(scores, places, found[part], chunk[col[part]], heads, content, search, own)
        return places, scores

    def _ranked_in(
        self, scores: np.ndarray, places: np.ndarray, row: np.ndarray, place: np.ndarray, heads: np.ndarray,
        content: np.ndarray | None, search: _Search, own: np.ndarray,
    ) -> None:
        """Puts the pairs (query row, document place) among the k best of their queries."""
        k = scores.shape[1]
        made = np.einsum("ij,ij->i", heads[row], self.dense[self.order[place]])
        if content is not None:
            made += content[row, self.kind[place]]
        if search.digits is not None:
            made = np.round(made, search.digits)
        kept = made >= scores[row, k - 1]
        if search.exclude_same:
            kept &= place != own[row]
        if search.min_score is not None:
            kept &= made >= search.min_score
        row, place, made = row[kept], place[kept], made[kept]
        if not len(row):
            return
        changed = np.unique(row)
        row = np.concatenate([row, np.repeat(changed, k)])
        place, made = np.concatenate([place, places[changed].ravel()]), np.concatenate([made, scores[changed].ravel()])
        order = np.lexsort((place, -made, row))
        row, place, made = row[order], place[order], made[order]
        at = np.arange(len(row)) - np.searchsorted(row, row)
        best = at < k
        scores[row[best], at[best]], places[row[best], at[best]] = made[best], place[best]

    def cell_best(self, heads: np.ndarray, search: _Search, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, scores) of the k best, as ``head_best`` gives them, by cells of equal signs.

        A query first meets the outer cells that share most of its signs; from then on it leaves out every cell whose
        bound is below its k-th best. Queries that would meet most cells anyway take the chunks.
        """
        n, norms = len(heads), np.sqrt(np.einsum("ij,ij->i", heads, heads))
        if self.cells is None or (n and not norms.max() <= LARGEST_NARROW):
            return self._by_steps(heads, search, own, k)
        cells, narrow = self.cells, heads.astype(np.float32)
        scores, places = np.full((n, k), -np.inf), np.full((n, k), len(self.ids), np.int64)
        most = norms * cells.longest
        doubt = most * ROUGH * (heads.shape[1] + 4) + 2 * 10.0**-search.digits
        outer, inner, inner_most = cells.shares(heads, norms)
        met = np.zeros(outer.shape, bool)

        def floors(rows: np.ndarray | slice) -> tuple[np.ndarray, np.ndarray]:
            """What a product in single precision must reach, and the share of a query's square that a cell must have."""
            floor = scores[rows, k - 1] - doubt[rows]
            if search.min_score is not None:
                floor = np.maximum(floor, search.min_score - doubt[rows])
            share = np.minimum(np.maximum(floor, 0.0) / np.maximum(most[rows], 1e-300), 2.0)  # no cell has more than 1
            return floor, (share**2 - 1e-5).astype(np.float32)

        def rank(row: np.ndarray, place: np.ndarray) -> None:
            step = max(1, PAIR_NUMBERS // max(1, heads.shape[1]))
            for first in range(0, len(row), step):
                part = slice(first, first + step)
                self._ranked_in(scores, places, row[part], place[part], heads, None, search, own)

        first = min(NEAREST, len(outer))
        nearest = np.argpartition(-outer, first - 1, axis=0)[:first]
        nearest = np.take_along_axis(nearest, np.argsort(-np.take_along_axis(outer, nearest, 0), axis=0), 0)
        for cell in nearest:
            _, least = floors(slice(None))
            by_cell = np.argsort(cell, kind="stable")
            by_cell = by_cell[outer[cell, np.arange(n)][by_cell] + inner_most[by_cell] >= least[by_cell]]
            cuts = np.searchsorted(cell[by_cell], np.arange(len(outer) + 1))
            for c in np.flatnonzero(np.diff(cuts)):
                rows = by_cell[cuts[c] : cuts[c + 1]]
                met[c, rows] = True
                for a in range(cells.outer[c], cells.outer[c + 1], CHUNK):
                    b = min(a + CHUNK, cells.outer[c + 1])
                    for at in range(0, len(rows), STEP):
                        part = rows[at : at + STEP]
                        rough, (floor, _) = narrow[part] @ cells.block[a:b].T, floors(part)
                        self.scored += rough.size
                        fresh, some = np.flatnonzero(np.isneginf(scores[part, k - 1])), min(b - a, STEP)
                        if len(fresh) and some > k + 1:  # one of them may be the query itself
                            low = np.partition(rough[fresh, :some], some - k - 1, axis=1)[:, some - k - 1]
                            floor[fresh] = np.maximum(floor[fresh], low - 2 * doubt[part[fresh]])
                        row, col = np.divmod(_spots(rough >= floor[:, None]), b - a)
                        rank(part[row], cells.places[a + col])

        _, least = floors(slice(None))
        many = cells.met_by(outer, inner, least) > MOST_MET
        many |= np.isneginf(scores[:, k - 1])  # fewer than k so far
        least[many] = np.inf
        for c in range(len(outer)):
            rows = np.flatnonzero((outer[c] + inner_most >= least) & ~met[c])
            if not len(rows):
                continue
            floor, need = floors(rows)
            own_heads, need, held = narrow.take(rows, axis=0), need - outer[c, rows], []
            pairs = 0
            shared, floor = inner.take(rows, axis=1), floor.astype(np.float32)
            for kind, a, b in cells.within(c):
                open_ = np.flatnonzero(shared[kind] >= need)
                for at in range(0, len(open_), CHUNK):
                    part = open_[at : at + CHUNK]
                    rough = cells.block[a:b] @ own_heads.take(part, axis=0).T
                    self.scored += rough.size
                    hot = np.flatnonzero(rough.max(axis=0) >= floor.take(part))
                    if len(hot):
                        part = part[hot]
                        col, row = np.nonzero(rough.take(hot, axis=1) >= floor[part])
                        held.append((rows[part[row]], cells.places[a + col]))
                        pairs += len(row)
                        if pairs > PAIR_NUMBERS:
                            rank(*(np.concatenate(x) for x in zip(*held)))
                            floor, held, pairs = floors(rows)[0].astype(np.float32), [], 0
            if held:
                rank(*(np.concatenate(x) for x in zip(*held)))
                _, least[rows] = floors(rows)
        if many.any():
            places[many], scores[many] = self._by_steps(heads[many], search, own[many], k)
        return places, scores

    def _by_steps(self, heads: np.ndarray, search: _Search, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        found = [
            self.head_best(heads[at : at + STEP], None, search, own[at : at + STEP], k, self.chunks)
            for at in range(0, len(heads), STEP)
        ]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def reach(self, heads: np.ndarray, content: np.ndarray | None = None) -> np.ndarray:
        """Least and largest product of each query with any document, ranked or not."""
        whole, nobody = _Unranked(), np.full(len(heads), -1, np.int64)
        _, high = self.head_best(heads, content, whole, nobody, 1, self.every)
        _, low = self.head_best(-heads, None if content is None else -content, whole, nobody, 1, self.every)
        return np.hstack([-low, high])

    def sparse_best(self, entries: np.ndarray, weights: np.ndarray, search: _Search, own: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, scores) of the k best of one sparse query; ``sums`` is a zeroed array, zeroed again at the end.

        Slots are taken from the one that can add most. Once those left cannot lift a document that was not met
        among the best k, their lists are not read; what can still be among the best is worked out from its row.
        """
        k = search.k
        reach = np.maximum(weights * self.most[entries], weights * self.least[entries])
        sink = np.minimum(weights * self.most[entries], weights * self.least[entries])
        order = np.argsort(-reach, kind="stable")
        # what the slots from each place on can add to a document or take from it
        left = np.append(np.cumsum(reach[order][::-1])[::-1], 0.0)
        lost = np.append(np.cumsum(sink[order][::-1])[::-1], 0.0)
        met: list[np.ndarray] = []
        many, turn, seen_kth, kth, slack = 0, -1, 0.0, -np.inf, 2 * 10.0**-search.digits
        gain = 0.0
        for turn, e in enumerate(order):
            docs, w = self.list_of(entries[e])
            sums[docs] += weights[e] * w
            new = docs[~self.seen[docs]]
            self.seen[new] = True
            met.append(new)
            many += len(new)
            gain += reach[e]  # the k-th best cannot have grown by more since it was looked at
            if many > k and turn + 1 < len(order) and left[turn + 1] + slack < seen_kth + gain:
                held = np.concatenate(met)
                if self.ranked is not None:
                    held = held[self.ranked[held]]
                if len(held) > k:  # one of them may be the query itself
                    seen_kth, gain = np.partition(sums[held], len(held) - k - 1)[len(held) - k - 1], 0.0
                    kth = seen_kth + lost[turn + 1]
                    if left[turn + 1] + slack < kth:
                        break
        cand = np.concatenate(met) if met else np.zeros(0, np.int64)
        self.scored += len(cand)
        reading = np.sort(cand[sums[cand] + left[turn + 1] + slack >= kth])
        rest = order[turn + 1 :]
        if self.lengths[entries[rest]].sum() <= (self.row_starts[reading + 1] - self.row_starts[reading]).sum():
            for e in rest:  # cheaper than the candidates' rows; whoever is met only now is not among the best
                docs, w = self.list_of(entries[e])
                sums[docs] += weights[e] * w
                met.append(docs)
            exact = sums[reading]
            sums[np.concatenate(met) if met else cand] = 0.0
        else:
            exact = self._rows(reading, entries, weights)
            sums[cand] = 0.0
        self.seen[cand] = False
        values = search.allowed(exact[None, :], reading, np.array([own]))[0] if len(reading) else exact
        if (values > 0).sum() < k:  # documents that share no slot have the product 0 and compete too
            every = np.arange(len(self.ids)) if self.ranked is None else np.flatnonzero(self.ranked)
            others = np.setdiff1d(every[: len(cand) + k + 1], cand)
            reading = np.concatenate([reading, others])
            by_place = np.argsort(reading)
            reading, values = reading[by_place], np.concatenate([exact, np.zeros(len(others))])[by_place]
            values = search.allowed(values[None, :], reading, np.array([own]))[0] if len(reading) else values
        best = np.lexsort((reading, -values))[:k]
        return reading[best], values[best]

    def sparse_above(
        self, entries: np.ndarray, weights: np.ndarray, search: _Search, own: int, floor: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """(positions, scores) of the k best of one sparse query among the documents of at least ``floor`` > 0.

        All its lists are added up in one pass; a document without any of its slots has the product 0.
        """
        if not len(entries):
            return np.zeros(0, np.int64), np.zeros(0)
        lists, slack = [self.list_of(e) for e in entries.tolist()], 2 * 10.0**-search.digits
        made = np.concatenate([w for _, w in lists]) * np.repeat(weights, self.lengths[entries])
        values = np.bincount(np.concatenate([docs for docs, _ in lists]), made, len(self.ids))
        self.scored += len(made)
        places = np.flatnonzero(values >= floor - slack)
        if len(places) > search.k + 1:  # one of them may be the query itself
            least = np.partition(values[places], -search.k - 1)[-search.k - 1]
            places = places[values[places] >= least - slack]
        if not len(places):
            return places, np.zeros(0)
        values = search.allowed(values[places][None, :], places, np.array([own]))[0]
        best = np.lexsort((places, -values))[: search.k]
        return places[best], values[best]

    def _rows(self, places: np.ndarray, entries: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Products of a sparse query with the rows of some documents."""
        self.asked[entries] = weights
        n = self.row_starts[places + 1] - self.row_starts[places]
        flat = np.arange(n.sum()) + np.repeat(self.row_starts[places] - np.cumsum(n) + n, n)
        out = np.bincount(np.repeat(np.arange(len(places)), n), self.asked[self.row_entries[flat]] * self.row_weights[flat], len(places))
        self.asked[entries] = 0.0
        return out


class _Cells:
    """Documents by the signs of some of their numbers, for vectors of about equal norms.

    A number whose sign differs from the query's takes from a product, so a product is at most the norm of the
    query's other numbers times that of the document. The share of a query's square that agrees with a cell is the sum
    of one part for the outer signs and one for the inner signs. Cells with the same outer signs lie together.
    """

    def __init__(self, dense: np.ndarray, rows: np.ndarray, places: np.ndarray, longest: float):
        positive = dense[rows] >= 0
        even = positive.mean(axis=0)
        tells = np.einsum("ij,ij->j", dense, dense) * np.minimum(even, 1 - even)
        signs = min(dense.shape[1], 16, max(2, int(np.log2(len(rows) / CELL))))
        self.columns, self.n_inner = np.argsort(-tells, kind="stable")[:signs], signs // 2
        code = positive[:, self.columns] @ (1 << np.arange(signs)[::-1])
        order = np.argsort(code, kind="stable")
        code, self.places, self.longest = code[order], places[order], longest
        self.block = dense[rows[order]].astype(np.float32)
        self.codes, starts = np.unique(code, return_index=True)
        self.starts = np.append(starts, len(code))
        self.outer_codes, first = np.unique(self.codes >> self.n_inner, return_index=True)
        self.cells = np.append(first, len(self.codes))
        self.outer = self.starts[self.cells]

    def shares(self, heads: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The shares of the outer cells (one row each, with all unsigned numbers), of the inner signs, and the largest of those."""
        unit = heads / np.where(norms > 0, norms, 1.0)[:, None]
        square = (unit * unit).astype(np.float32)
        signed = square[:, self.columns]
        positive, n = np.where(unit[:, self.columns] > 0, signed, np.float32(0)), len(self.columns) - self.n_inner
        negative = signed - positive

        def agreeing(codes: np.ndarray, part: slice) -> np.ndarray:
            width = positive[:, part].shape[1]
            bits = (codes[:, None] >> np.arange(width)[::-1] & 1).astype(np.float32)
            return bits @ (positive - negative)[:, part].T + negative[:, part].sum(axis=1)

        rest = square.sum(axis=1) - signed.sum(axis=1)
        outer = agreeing(self.outer_codes, slice(0, n)) + rest
        return outer, agreeing(np.arange(1 << self.n_inner), slice(n, None)), signed[:, n:].sum(axis=1)

    def met_by(self, outer: np.ndarray, inner: np.ndarray, least: np.ndarray) -> np.ndarray:
        """About which part of the documents lies in cells that a query has to meet."""
        at = np.linspace(0, len(self.places) - 1, 128).astype(np.int64)
        codes = self.codes[np.searchsorted(self.starts, at, side="right") - 1]
        out, inn = np.searchsorted(self.outer_codes, codes >> self.n_inner), codes & (1 << self.n_inner) - 1
        return np.mean([outer[o] + inner[i] >= least for o, i in zip(out, inn)], axis=0)

    def within(self, c: int) -> Iterator[tuple[int, int, int]]:
        """(inner signs, first, end) of the cells of an outer cell, in parts of at most CHUNK documents."""
        for i in range(self.cells[c], self.cells[c + 1]):
            kind, end = int(self.codes[i]) & (1 << self.n_inner) - 1, int(self.starts[i + 1])
            for a in range(int(self.starts[i]), end, CHUNK):
                yield kind, a, min(a + CHUNK, end)


class _Lists(_Wave):
    """Only what ``sparse_above`` reads: posting lists of documents sorted by id, in about half the memory."""

    def __init__(self, ids: np.ndarray, vectors: _Vectors):
        order = _sorted_places(ids)
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        by_slot = np.argsort(vectors.slots, kind="stable")
        self.ids, self.docs, self.weights = ids[order], place[vectors.rows[by_slot]], vectors.weights[by_slot]
        self.slots, starts = np.unique(vectors.slots[by_slot], return_index=True)
        self.starts = np.append(starts, len(by_slot))
        self.lengths = np.diff(self.starts)
        self.scored = 0


class _Unranked:
    """What ``_Wave.head_best`` asks of a search, for products as they are."""

    exclude_same, min_score, digits = False, None, None


class _Search:
    """Block search shared by the plans below; pickled into the tasks."""

    def __init__(self, queries: DataFrame, docs: DataFrame, query_id: str, doc_id: str, k: int, exclude_same, min_score, digits, extent=False, scale=None):
        q_type = queries.schema[query_id].dataType.simpleString()
        d_type = docs.schema[doc_id].dataType.simpleString()
        self.schema = f"`{query_id}` {q_type}, `{doc_id}` {d_type}, score double"
        self.types = [arrow_type(t) for t in (q_type, d_type)] + [pa.float64()]
        self.names = [query_id, doc_id, "score"]
        self.extent, self.scale = extent, scale
        if extent:
            self.schema += ", _lo double, _hi double"
            self.types += [pa.float64()] * 2
            self.names += ["_lo", "_hi"]
        self.k, self.exclude_same, self.min_score, self.digits = k, exclude_same, min_score, digits

    def top(self, qid: np.ndarray, queries: _Vectors, did: np.ndarray, docs: _Vectors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, scores, extents), one row per query, best first; scores of left-out documents are -inf.

        The extent of a query is its least and largest product with any document.
        """
        qv, dv = _aligned(queries, docs)
        by_id = np.argsort(did, kind="stable")
        did, dv = did[by_id], dv[by_id]
        ids, values, extents = [], [], []
        step = max(1, (16 << 20) // max(1, len(did)))  # at most 16M scores in memory at a time
        for at in range(0, len(qid), step):
            part = qid[at : at + step]
            scores = qv[at : at + step] @ dv.T
            extents.append(np.stack([scores.min(axis=1), scores.max(axis=1)], axis=1))
            scores = np.round(scores, self.digits)
            if self.exclude_same:
                pos = np.minimum(np.searchsorted(did, part), len(did) - 1)
                own = np.flatnonzero(did[pos] == part)
                scores[own, pos[own]] = -np.inf
            if self.min_score is not None:
                scores[scores < self.min_score] = -np.inf
            order, best = _best(scores, did, self.k)
            ids.append(did[order])
            values.append(best)
        return np.concatenate(ids), np.concatenate(values), np.concatenate(extents)

    def allowed(self, scores: np.ndarray, places: np.ndarray, own: np.ndarray, ranked: np.ndarray | None = None) -> np.ndarray:
        """Scores as they are ranked: rounded, -inf for left-out documents. ``places`` are the sorted columns' positions."""
        scores = np.round(scores, self.digits)
        if self.exclude_same:
            at = np.minimum(np.searchsorted(places, own), len(places) - 1)
            same = np.flatnonzero(places[at] == own)
            scores[same, at[same]] = -np.inf
        if self.min_score is not None:
            scores[scores < self.min_score] = -np.inf
        if ranked is not None:
            scores[:, ~ranked] = -np.inf
        return scores

    def stream(self, wave: _Wave, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k best documents of the wave for every query of a partition."""
        n, sums = len(wave.ids), np.zeros(len(wave.ids))
        for b in batches:
            if b.num_rows == 0 or n == 0:
                continue
            qid, queries = _ids(b.column(0)), _Vectors(b.column(1))
            if queries.dense.shape[1] != wave.dense.shape[1]:
                raise ValueError(f"vectors of different lengths: {queries.dense.shape[1]} and {wave.dense.shape[1]}")
            own = np.full(len(qid), -1, np.int64)
            if self.exclude_same:
                at = np.minimum(np.searchsorted(wave.ids, qid), n - 1)
                own = np.where(wave.ids[at] == qid, at, -1)
            if queries.dense.shape[1] and not self.extent and self.scale is None and not len(wave.slots):
                places, scores = wave.cell_best(queries.dense, self, own, self.k)
                yield self.rows(qid, wave.ids[np.minimum(places, n - 1)], scores, np.zeros((len(qid), 2)))
                continue
            tails = wave.tails(queries)
            step = STEP if wave.kind is None else min(STEP, max(1, PAIR_NUMBERS // wave.n_kinds))
            for first in range(0, len(qid), step):
                part = slice(first, first + step)
                heads, reach = queries.dense[part], np.zeros((len(qid[part]), 2))
                if not queries.dense.shape[1] and not self.extent:
                    found = [wave.sparse_best(*t, self, int(o), sums) for t, o in zip(tails[part], own[part])]
                    places, scores = (_padded([f[i] for f in found], self.k, fill) for i, fill in ((0, 0), (1, -np.inf)))
                else:
                    content = wave.contents(tails[part])
                    if self.extent:
                        reach = wave.reach(heads, content)
                    if self.scale is not None:  # the range of the heads alone
                        reach = wave.reach(heads)
                        factor = self.scale(reach)
                        heads = heads * factor[:, None]
                    places, scores = wave.head_best(heads, content, self, own[part], self.k, wave.chunks)
                    if self.scale is not None:
                        scores = scores - (reach[:, 0] * factor)[:, None]
                    places = np.minimum(places, n - 1)
                yield self.rows(qid[part], wave.ids[places], scores, reach)

    def gather(self, asked: pa.Table, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k best documents of a partition for every sparse query: k rows per query leave it, whatever its size.

        Documents are indexed LIST_NUMBERS numbers at a time; the k-th best so far is the floor of what comes next.
        """
        qid, queries = _ids(asked.column(0)), _Vectors(asked.column(1))
        n, held, scores = len(qid), None, None
        floor = np.full(n, self.min_score)
        for part in _portions(batches):
            ids, docs = _ids(part.column(0)), _Vectors(part.column(1))
            if queries.dense.shape[1] or docs.dense.shape[1]:
                raise ValueError("only sparse vectors are gathered")
            wave, own = _Lists(ids, docs), np.full(n, -1, np.int64)
            del docs
            if self.exclude_same:
                at = np.minimum(np.searchsorted(wave.ids, qid), len(wave.ids) - 1)
                own = np.where(wave.ids[at] == qid, at, -1)
            places, made = np.zeros((n, self.k), np.int64), np.full((n, self.k), -np.inf)
            for i, tail in enumerate(wave.each_tail(queries)):
                at, values = wave.sparse_above(*tail, self, int(own[i]), float(floor[i]))
                places[i, : len(at)], made[i, : len(at)] = at, values
            best = wave.ids[places]
            if held is not None:
                best, made = np.hstack([held, best]), np.hstack([scores, made])
                by_id = np.argsort(best, axis=1, kind="stable")
                best, made = np.take_along_axis(best, by_id, 1), np.take_along_axis(made, by_id, 1)
                first = np.argsort(-made, axis=1, kind="stable")[:, : self.k]
                best, made = np.take_along_axis(best, first, 1), np.take_along_axis(made, first, 1)
            held, scores = best, made
            floor = np.maximum(floor, scores[:, self.k - 1])
        for at in range(0, n if held is not None else 0, LEFT_BLOCK):
            rows = slice(at, at + LEFT_BLOCK)
            yield self.rows(qid[rows], held[rows], scores[rows], np.zeros((0, 2)))

    def rows(self, qid: np.ndarray, ids: np.ndarray, scores: np.ndarray, extents: np.ndarray) -> pa.RecordBatch:
        r, c = np.nonzero(np.isfinite(scores))
        arrays = [qid[r].tolist(), ids[r, c].tolist(), scores[r, c]]
        if self.extent:
            arrays += [extents[r, 0], extents[r, 1]]
        return pa.RecordBatch.from_arrays([pa.array(a, type=t) for a, t in zip(arrays, self.types)], names=self.names)

    def empty(self) -> pa.Table:
        return pa.schema(list(zip(self.names, self.types))).empty_table()

    def pair(self, left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            return self.empty()
        wave = _Wave(_ids(right[self.names[1]]), _Vectors(right["_dv"]))
        sent = left.select([self.names[0], "_qv"]).to_batches()
        return pa.Table.from_batches(self.stream(wave, sent), self.empty().schema)

    def scan(self, qid: np.ndarray, qv: _Vectors, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Running best k over all batches of a partition: k rows per query leave it, whatever its size."""
        held: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
        for b in batches:
            if b.num_rows == 0 or len(qid) == 0:
                continue
            found = self.top(qid, qv, _ids(b.column(0)), _Vectors(b.column(1)))
            if held is not None:
                ids, scores = np.hstack([held[0], found[0]]), np.hstack([held[1], found[1]])
                by_id = np.argsort(ids, axis=1, kind="stable")
                ids, scores = np.take_along_axis(ids, by_id, 1), np.take_along_axis(scores, by_id, 1)
                best = np.argsort(-scores, axis=1, kind="stable")[:, : self.k]
                reach = np.stack([np.minimum(held[2][:, 0], found[2][:, 0]), np.maximum(held[2][:, 1], found[2][:, 1])], axis=1)
                found = np.take_along_axis(ids, best, 1), np.take_along_axis(scores, best, 1), reach
            held = found
        if held is not None:
            yield self.rows(qid, *held)


def _spots(mask: np.ndarray) -> np.ndarray:
    """``np.flatnonzero`` of a mask with few hits, eight places at a time."""
    flat = np.ascontiguousarray(mask).ravel()
    whole = len(flat) & ~7
    near = (np.flatnonzero(flat[:whole].view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    return np.concatenate([near[flat[near]], whole + np.flatnonzero(flat[whole:])])


def _padded(rows: list[np.ndarray], k: int, fill: float) -> np.ndarray:
    out = np.full((len(rows), k), fill, dtype=rows[0].dtype if rows else None)
    for row, values in zip(out, rows):
        row[: len(values)] = values
    return out


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches of (id, sparse vector) brought together, and cut, to about LIST_NUMBERS weights, the first to fewer."""
    held, many, most = [], 0, LIST_NUMBERS // 8
    for b in batches:
        ends = np.cumsum(pc.list_value_length(b.column(1).field(1)).fill_null(0).to_numpy(zero_copy_only=False))
        at = 0
        while at < b.num_rows:
            before = ends[at - 1] if at else 0
            to = max(int(np.searchsorted(ends, before + most - many, side="right")), at + 1)
            held.append(b.slice(at, to - at))
            many += ends[min(to, b.num_rows) - 1] - before
            at = to
            if many >= most or at < b.num_rows:
                yield pa.Table.from_batches(held)
                held, many, most = [], 0, LIST_NUMBERS
    if held:
        yield pa.Table.from_batches(held)


def _bytes(df: DataFrame, vector: str) -> int:
    """Bytes that the numbers of a vector column take in a task."""
    kind = df.schema[vector].dataType
    arrays = [(vector, kind)] if kind.typeName() == "array" else [(f"{vector}.`{f.name}`", f.dataType) for f in kind.fields]
    numbers = reduce(Column.__add__, [F.size(name) for name, _ in arrays])
    return 8 * (df.agg(F.sum(numbers + 2).alias("n")).first()["n"] or 0)


def waves(docs: DataFrame, doc_id: str, vector: str) -> Iterator[Iterator[pa.Table]] | None:
    """The documents in tables of about WAVE_BYTES, each in pieces of PIECE_BYTES, or None where they are too many to travel."""
    size = _bytes(docs, vector)
    n, pieces = -(-size // WAVE_BYTES) or 1, -(-min(size, WAVE_BYTES) // PIECE_BYTES) or 1
    if n > MOST_WAVES:
        return None
    if n * pieces == 1:
        return iter([iter([docs.toArrow()])])
    part = F.pmod(F.xxhash64(doc_id), F.lit(n * pieces))
    if n > 1:  # a piece then reads its own folder, not all documents
        docs = written(docs.withColumn("_piece", part.cast("int")).repartition(n * pieces, "_piece"), "pieces", "_piece")
    else:
        docs = docs.withColumn("_piece", part)

    def wave(i: int) -> Iterator[pa.Table]:
        return (docs.where(F.col("_piece") == i * pieces + j).drop("_piece").toArrow() for j in range(pieces))

    return (wave(i) for i in range(n))


def thinned(docs: DataFrame, k: int, doc_id: str, vector: str = "vector") -> DataFrame:
    """Of the documents with equal vectors the k lowest ids: the others cannot be among the k best of any query."""
    equal = Window.partitionBy(F.xxhash64(vector), vector).orderBy(doc_id)
    return docs.withColumn("_copy", F.row_number().over(equal)).where(F.col("_copy") <= k).drop("_copy")


def topk_inner_product(
    queries: DataFrame,
    docs: DataFrame,
    k: int,
    query_id: str = "query_id",
    doc_id: str = "id",
    vector: str = "vector",
    exclude_same: bool = False,
    min_score: float | None = None,
    digits: int = _DIGITS,
    route: str = "checked",
    extent: bool = False,
) -> DataFrame:
    """query_id, doc_id, score, rank: the k documents of largest inner product for every query.

    Rows with a null vector match nothing; vectors of unequal lengths are an error. ``route``: "checked" sends a
    query table of at most QUERY_BATCH_ROWS rows and QUERY_BATCH_BYTES to the document scan, else documents of at
    most MOST_WAVES waves to the scan of the queries, and otherwise does as "pair", which meets queries and
    documents block by block; "documents" leaves the first of these out, for sparse vectors with many slots; "queries"
    sends sparse queries of at most MOST_WAVES waves to the scan of sparse documents, for documents of many more
    numbers than the queries, and needs a ``min_score`` above 0. All give the same rows. ``extent`` adds min_score and max_score of each query over all documents, from the same products.
    """
    if route not in ("checked", "documents", "queries", "pair"):
        raise ValueError(f"unknown route: {route}")
    if route == "queries" and (extent or min_score is None or min_score <= 0):
        raise ValueError('route "queries" gives no extent and needs a min_score above 0')
    q, d = queries.select(F.col(query_id), F.col(vector).alias("_qv")), docs.select(F.col(doc_id), F.col(vector).alias("_dv"))
    search = _Search(q, d, query_id, doc_id, k, exclude_same, min_score, digits, extent)
    if route == "checked":  # vectors are read several times; what they come from need not be, nor be worked out for the filter
        q = settle(q)
    q, unfiltered, d = q.where("_qv is not null"), d, d.where("_dv is not null")
    batch = q.limit(QUERY_BATCH_ROWS + 1).toArrow() if route == "checked" else None
    if batch is not None and batch.num_rows <= QUERY_BATCH_ROWS and batch.nbytes <= QUERY_BATCH_BYTES:
        shipped = queries.sparkSession.sparkContext.broadcast(batch)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked = shipped.value
            return search.scan(_ids(asked[query_id]), _Vectors(asked["_qv"]), batches)

        partial = d.mapInArrow(scan, search.schema)
    elif route == "queries" and (parts := waves(q, query_id, "_qv")) is not None:
        partial = reduce(DataFrame.unionAll, [_gathered(d, part, search) for part in parts])
    else:
        partial = None
        if route in ("checked", "documents"):
            d = settle(unfiltered).where("_dv is not null") if route == "checked" else d
            partial = _past(lambda: spread(gathered(q, QUERY_TASK_ROWS) if route == "checked" else q, query_id), d, doc_id, search)
    if partial is None:
        lefts, rights, _, _ = block_pairs(q, d, query_id, doc_id, LEFT_BLOCK, RIGHT_BLOCK)
        partial = lefts.groupBy("_lb", "_rb").cogroup(rights.groupBy("_lb", "_rb")).applyInArrow(lambda a, b: search.pair(a, b), search.schema)
    return _merge(partial, query_id, doc_id, k)


def _streamed(queries: DataFrame, wave: Iterable[pa.Table], search: _Search, ranked: str | None = None) -> DataFrame:
    """Queries past one wave of documents (id, vector and perhaps a flag of those that are ranked)."""
    shipped = [queries.sparkSession.sparkContext.broadcast(_packed(piece)) for piece in wave]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = pa.concat_tables([pa.ipc.open_stream(piece.value).read_all() for piece in shipped])
        flags = None if ranked is None else docs[ranked].to_numpy(zero_copy_only=False).astype(bool)
        yield from search.stream(_Wave(_ids(docs[0]), _Vectors(docs[1]), flags), batches)

    return queries.mapInArrow(stream, search.schema)


def _past(laid_out: Callable[[], DataFrame], docs: DataFrame, doc_id: str, search: _Search) -> DataFrame | None:
    """The queries of ``laid_out`` past the documents (id, _dv) wave by wave, or None where these are too many to travel.

    One wave travels through the driver. Several lie in storage, one row of compressed Arrow each, and a task reads its
    wave and its queries from there, so what the driver holds does not grow with the documents.
    """
    n = -(-_bytes(docs, "_dv") // WAVE_BYTES) or 1
    if n > MOST_WAVES:
        return None
    queries = laid_out()
    if n == 1:
        return reduce(DataFrame.unionAll, [_streamed(queries, part, search) for part in waves(docs, doc_id, "_dv")])
    wave = F.pmod(F.xxhash64(doc_id), F.lit(n)).cast("int").alias("_wave")
    dealt = docs.select(doc_id, "_dv", wave).repartitionById(n, "_wave").drop("_wave")
    bundles = [settle(df.mapInArrow(_bundles(most), "data binary")) for df, most in ((queries, PIECE_BYTES), (dealt, None))]
    asked, stored = bundles[0], bundles[1].select(F.spark_partition_id().alias("wave"), "data")

    def run(pairs: Iterator) -> Iterator[tuple[bytes]]:
        at, index = None, None
        for (batch,), (wave, data) in pairs:
            if wave != at:
                table = _unpacked(data)
                at, index = wave, _Wave(_ids(table[0]), _Vectors(table[1]))
                del table
            for found in search.stream(index, iter(_unpacked(batch).to_batches())):
                yield (_packed(pa.Table.from_batches([found])),)

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0):
                yield from _unpacked(data.as_buffer()).to_batches()

    found = asked.rdd.cartesian(stored.rdd).mapPartitions(run)
    return queries.sparkSession.createDataFrame(found, "data binary", verifySchema=False).mapInArrow(opened, search.schema)


def _bundles(most: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of a partition as compressed Arrow, one value for about every ``most`` bytes, or one for the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            rows = b.num_rows if most is None else max(1, int(b.num_rows * most / max(b.nbytes, 1)))
            for at in range(0, b.num_rows, rows or 1):
                part = b.slice(at, rows)
                if held and most is not None and size + part.nbytes > most:
                    yield pa.RecordBatch.from_arrays([pa.array([_packed(pa.Table.from_batches(held))], pa.binary())], names=["data"])
                    held, size = [], 0
                held.append(part)
                size += part.nbytes
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([_packed(pa.Table.from_batches(held))], pa.binary())], names=["data"])

    return run


def _gathered(docs: DataFrame, wave: Iterable[pa.Table], search: _Search) -> DataFrame:
    """Documents past one wave of sparse queries (id, vector)."""
    shipped = [docs.sparkSession.sparkContext.broadcast(_packed(piece)) for piece in wave]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from search.gather(pa.concat_tables([pa.ipc.open_stream(piece.value).read_all() for piece in shipped]), batches)

    return docs.mapInArrow(gather, search.schema)


def _packed(table: pa.Table) -> bytes:
    """A table as compressed Arrow, since the driver and every executor keep a broadcast of their own."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes | pa.Buffer) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(data)).read_all()


def topk_minmax_sum(
    queries: DataFrame, docs: DataFrame, k: int, weight: float, guard: float, query_id: str, doc_id: str, ranked: str, digits: int = _DIGITS
) -> DataFrame | None:
    """query_id, doc_id, score, rank by ``weight * minmax(head product) + tail product``, or None for more than one wave.

    The range of the head's products is over all documents, ranked or not, so one product serves both.
    """
    d = docs.select(doc_id, F.col("vector").alias("_dv"), ranked)
    if _bytes(d, "_dv") > WAVE_BYTES:
        return None

    def scale(reach: np.ndarray) -> np.ndarray:
        return weight / (reach[:, 1] - reach[:, 0] + guard)

    q = queries.select(query_id, F.col("vector").alias("_qv"))
    search = _Search(q, d, query_id, doc_id, k, False, None, digits, scale=scale)
    return _merge(_streamed(spread(q, query_id), [d.toArrow()], search, ranked), query_id, doc_id, k)


def topk_in_cells(
    probes: DataFrame,
    docs: DataFrame,
    k: int,
    cell: str = "centroid",
    query_id: str = "query_id",
    doc_id: str = "id",
    vector: str = "vector",
    exclude_same: bool = False,
    min_score: float | None = None,
    digits: int = _DIGITS,
) -> DataFrame:
    """Top-k where a query meets only the documents of its probed cells; ``probes`` has (query_id, vector, cell).

    Cells are cut into sub-blocks of about RIGHT_BLOCK rows (and their queries into LEFT_BLOCK) by a hash of
    the id, so a cell that holds a third of the documents becomes many tasks.
    """
    q = probes.select(F.col(query_id), F.col(cell), F.col(vector).alias("_qv")).where("_qv is not null")
    d = docs.select(F.col(doc_id), F.col(cell), F.col(vector).alias("_dv")).where("_dv is not null")
    search = _Search(q, d, query_id, doc_id, k, exclude_same, min_score, digits)
    sizes_d = d.groupBy(cell).agg(F.ceil(F.count(F.lit(1)) / RIGHT_BLOCK).alias("_nr"))
    sizes_q = q.groupBy(cell).agg(F.ceil(F.count(F.lit(1)) / LEFT_BLOCK).alias("_nl"))
    # one row per cell; the number of cells is a build parameter (at most a few thousand)
    sizes = F.broadcast(sizes_d.join(sizes_q, cell))
    lefts = (
        q.join(sizes, cell)
        .withColumn("_lb", F.pmod(F.xxhash64(query_id), F.col("_nl")))
        .withColumn("_rb", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_nr") - 1)))
    )
    rights = (
        d.join(sizes, cell)
        .withColumn("_rb", F.pmod(F.xxhash64(doc_id), F.col("_nr")))
        .withColumn("_lb", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_nl") - 1)))
    )
    partial = (
        lefts.drop("_nl", "_nr")
        .groupBy(cell, "_lb", "_rb")
        .cogroup(rights.drop("_nl", "_nr").groupBy(cell, "_lb", "_rb"))
        .applyInArrow(lambda a, b: search.pair(a, b), search.schema)
    )
    return _merge(partial, query_id, doc_id, k)


def score_range(
    left: DataFrame, right: DataFrame, left_id: str, right_id: str, vector: str = "vector"
) -> DataFrame:
    """left_id, min_score, max_score, n: the extent of the inner products of each left row with all right rows."""
    lhs = left.select(left_id, F.col(vector).alias("_lv")).where("_lv is not null")
    rhs = right.select(right_id, F.col(vector).alias("_rv")).where("_rv is not null")
    lhs, rhs = settle(lhs), settle(rhs)
    search = _Search(lhs, rhs, left_id, right_id, 1, False, None, _DIGITS, extent=True)
    ranges = _past(lambda: spread(lhs, left_id), rhs.withColumnRenamed("_rv", "_dv"), right_id, search)
    if ranges is not None:
        many = rhs.count()
        return ranges.groupBy(left_id).agg(
            F.min("_lo").alias("min_score"), F.max("_hi").alias("max_score"), F.lit(many).cast("long").alias("n_items")
        )
    lefts, rights, _, _ = block_pairs(lhs, rhs, left_id, right_id, LEFT_BLOCK, RIGHT_BLOCK)
    l_type = lhs.schema[left_id].dataType.simpleString()
    l_arrow = arrow_type(l_type)

    def extent(a: pa.Table, b: pa.Table) -> pa.Table:
        if a.num_rows == 0 or b.num_rows == 0:
            lo = hi = np.zeros(0)
            a = a.slice(0, 0)
        else:
            lv, rv = _aligned(_Vectors(a["_lv"]), _Vectors(b["_rv"]))
            s = lv @ rv.T
            lo, hi = s.min(axis=1), s.max(axis=1)
        return pa.table(
            {
                left_id: pa.array(a[left_id].to_pylist(), type=l_arrow),
                "lo": pa.array(lo, type=pa.float64()),
                "hi": pa.array(hi, type=pa.float64()),
                "n": pa.array([b.num_rows] * a.num_rows, type=pa.int64()),
            }
        )

    blocks = (
        lefts.groupBy("_lb", "_rb")
        .cogroup(rights.groupBy("_lb", "_rb"))
        .applyInArrow(extent, f"`{left_id}` {l_type}, lo double, hi double, n long")
    )
    return blocks.groupBy(left_id).agg(
        F.min("lo").alias("min_score"), F.max("hi").alias("max_score"), F.sum("n").alias("n_items")
    )
