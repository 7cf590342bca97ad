"""Fill-in-middle texts, cut with a piecewise-linear learned rank index over unit boundaries.

A text of n units has n + 1 boundaries, each with a byte offset. The index answers "at which byte does unit r
begin?": straight pieces are fitted to (rank, offset) so that no boundary is further than ``BOUND`` bytes from
its piece, and the difference that remains is stored in one signed byte a boundary. A cut is predicted by its
piece and made exact by its stored difference. One index serves all texts of a block of about ``BLOCK`` bytes
(units of one script lie on one line); boundaries are found in windows, so a long text needs no more than its
bytes, its differences and one window.

Units are code points, or the matches of a pattern (``WORDS``, ``LINES``) with the gap before each counted to
it; the last unit also takes what follows the last match.

A document's cuts and form come from a hash of its doc_id, so a replay gives the same rows. Forms: psm
(prefix, suffix, middle), spm (suffix, prefix, middle) and plain, which is the text as it was.

Nulls, ties and odd rows: a null text is the empty text and plain; a text that already holds a sentinel is
plain; a null doc_id is hashed as ``null``; rows with the same doc_id and text get the same result; extra
columns stay, those of the names that are added are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tastegrid.llm.words import groups, texts_of

#: What marks the parts of an output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Largest distance of a boundary from its piece; it has to fit a signed byte.
BOUND = 127
#: Bytes of one index and of one window in which boundaries are found.
BLOCK, WINDOW = 1 << 22, 1 << 20
#: Shares in percent: texts that get a form other than plain, and spm among these.
RATE, SPM = 90, 20
WORDS, LINES = r"[^\x20\x09-\x0D]+", r"[^\n]*\n|[^\n]+"
ADDED = ["n_units", "form", "prefix_units", "middle_units", "output"]


@dataclass
class RankIndex:
    """Byte offsets of boundaries: pieces start at ``ranks`` with ``offsets`` and ``slopes``; ``rest`` corrects."""

    ranks: np.ndarray
    offsets: np.ndarray
    slopes: np.ndarray
    rest: np.ndarray

    def predict(self, rank: np.ndarray) -> np.ndarray:
        piece = np.searchsorted(self.ranks, rank, side="right") - 1
        return self.offsets[piece] + np.rint((rank - self.ranks[piece]) * self.slopes[piece]).astype(np.int64)

    def offset(self, rank: np.ndarray) -> np.ndarray:
        """Exact byte offsets of boundaries 0 .. len(rest) - 1."""
        return self.predict(rank) + self.rest[rank]


def _reach(at: np.ndarray, first: int, last: int) -> np.ndarray | None:
    """Differences of boundaries first..last - 1 from the line through both ends; None if one is out of bounds."""
    many = last - first
    slope = (at[last - 1] - at[first]) / max(many - 1, 1)
    off = at[first:last] - at[first] - np.rint(np.arange(many) * slope).astype(np.int64)
    return off if max(off.max(), -off.min()) <= BOUND else None


def fit_pieces(at: np.ndarray) -> RankIndex:
    """The index of sorted offsets: each piece is the longest found by doubling, then halving, its length."""
    ranks, offsets, slopes, rest = [], [], [], np.empty(len(at), np.int8)
    first, guess = 0, 1 << 12
    while first < len(at):
        good, off = first + 1, np.zeros(1, np.int64)
        bad = len(at) + 1
        step = guess
        while good < len(at) and good + 1 < bad:
            last = min(good + step, len(at), bad - 1)
            tried = _reach(at, first, last)
            if tried is None:
                bad, step = last, max((last - good) // 2, 1)
            else:
                good, off = last, tried
                step = max((bad - good) // 2, 1) if bad <= len(at) else step * 2
        ranks.append(first)
        offsets.append(at[first])
        slopes.append((at[good - 1] - at[first]) / max(good - first - 1, 1))
        rest[first:good] = off
        guess = max(good - first, 2)
        first = good
    return RankIndex(np.array(ranks, np.int64), np.array(offsets, np.int64), np.array(slopes), rest)


def joined(parts: list[RankIndex]) -> RankIndex:
    """One index of consecutive runs of boundaries."""
    shift = np.cumsum([0] + [len(p.rest) for p in parts])
    ranks = [p.ranks + s for p, s in zip(parts, shift)]
    return RankIndex(*(np.concatenate(c) for c in (ranks, [p.offsets for p in parts], [p.slopes for p in parts], [p.rest for p in parts])))


def code_point_index(raw: np.ndarray) -> RankIndex:
    """The index of the first bytes of all code points of UTF-8 bytes, found window by window."""
    parts = []
    for start in range(0, len(raw), WINDOW):
        at = np.flatnonzero((raw[start : start + WINDOW] & 0xC0) != 0x80)
        if len(at):
            parts.append(fit_pieces(at + start))
    return joined(parts) if parts else fit_pieces(np.zeros(0, np.int64))


def pattern_index(text: str, pattern: str) -> RankIndex:
    """The index of unit starts of one text: 0, then the end of each match but the last."""
    parts, run, at, ascii_only = [], [0], 0, text.isascii()
    done, held = 0, None
    for m in re.finditer(pattern, text):
        if held is not None:
            at += held - done if ascii_only else len(text[done:held].encode())
            done = held
            run.append(at)
            if len(run) >= WINDOW:
                parts.append(fit_pieces(np.array(run, np.int64)))
                run = []
        held = m.end()
    if run and text and held is not None:
        parts.append(fit_pieces(np.array(run, np.int64)))
    return joined(parts) if parts else fit_pieces(np.zeros(0, np.int64))


def dealt(doc_id: object, n: int, rate: int = RATE, spm: int = SPM) -> tuple[str, int, int]:
    """Form and both cuts of a text of n units, from a hash of its id."""
    digest = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    form = "plain" if n == 0 or h3 % 100 >= rate else "spm" if h4 % 100 < spm else "psm"
    return form, a, b


def arranged(text: bytes, form: str, a: int, b: int) -> bytes:
    """The output for cuts at bytes a and b."""
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if form == "psm":
        return b"".join((PREFIX.encode(), prefix, SUFFIX.encode(), suffix, MIDDLE.encode(), middle))
    return b"".join((SUFFIX.encode(), suffix, PREFIX.encode(), prefix, MIDDLE.encode(), middle))


def _block(ids: list, raw: np.ndarray, bounds: np.ndarray, pattern: str | None, rate: int, spm: int) -> list[tuple]:
    """(n, form, prefix units, middle units, output) of the texts of one block."""
    base = int(bounds[0])
    body = raw[base : int(bounds[-1])]
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    out, asked, where = [], [], []
    if pattern is None:
        index = code_point_index(body)
        firsts = _first_ranks(index, bounds - base)
    for i, doc_id in enumerate(ids):
        text = body[bounds[i] - base : bounds[i + 1] - base].tobytes()
        if pattern is None:
            rank, n = int(firsts[i]), int(firsts[i + 1] - firsts[i])
            start = int(bounds[i]) - base
        else:
            index, rank, start = pattern_index(text.decode(), pattern), 0, 0
            n = len(index.rest)
        form, a, b = dealt(doc_id, n, rate, spm)
        if not text or any(m in text for m in marks):
            form = "plain"
        out.append([n, form, None if form == "plain" else a, None if form == "plain" else b - a, text])
        if form == "plain":
            continue
        cuts = _cut_offsets(index, [rank + a, rank + b]) if pattern is not None else None
        if cuts is None:
            asked += [rank + a, rank + b]
            where.append((i, start))
        else:
            out[i][4] = arranged(text, form, *(min(c - start, len(text)) for c in cuts))
    if asked:
        cuts = _cut_offsets(index, asked, len(body))
        for k, (i, start) in enumerate(where):
            text = out[i][4]
            out[i][4] = arranged(text, out[i][1], cuts[2 * k] - start, cuts[2 * k + 1] - start)
    return out


def _cut_offsets(index: RankIndex, ranks: list[int], end: int = 1 << 62) -> list[int]:
    """Byte offsets of ranks; the rank behind the last boundary is the end."""
    rank = np.array(ranks, np.int64)
    inside = rank < len(index.rest)
    at = np.full(len(rank), end, np.int64)
    at[inside] = index.offset(rank[inside])
    return at.tolist()


def _first_ranks(index: RankIndex, starts: np.ndarray) -> np.ndarray:
    """Rank of the first boundary at or behind each byte offset: bisection in the index itself."""
    low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(index.rest), np.int64)
    while (open_ := low < high).any():
        mid = (low + high) // 2
        behind = np.zeros(len(starts), bool)
        behind[open_] = index.offset(mid[open_]) < starts[open_]
        low, high = np.where(behind, mid + 1, low), np.where(open_ & ~behind, mid, high)
    return low


def _cut_batches(batches: Iterator[pa.RecordBatch], names: list[str], pattern: str | None, rate: int, spm: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, bounds = texts_of(batch.column("text"))
        ids = batch.column("doc_id")
        kept = [batch.column(c) for c in names]
        for first, last in groups(bounds, BLOCK):
            made = _block(ids.slice(first, last - first).to_pylist(), raw, bounds[first : last + 1], pattern, rate, spm)
            n, form, prefix, middle, output = zip(*made)
            yield pa.RecordBatch.from_arrays(
                [c.slice(first, last - first) for c in kept]
                + [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())]
                + [pa.array(output, pa.binary()).cast(pa.string())],
                names + ADDED,
            )


def fill_in_middle(docs: DataFrame, pattern: str | None = None, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """``docs`` with n_units, form, prefix_units, middle_units (null if plain) and output.

    ``pattern`` None cuts between code points, else between matches of it. One scan, no shuffle.
    """
    names = [c for c in docs.columns if c not in ADDED]
    kinds = [LongType(), StringType(), LongType(), LongType(), StringType()]
    schema = StructType([docs.schema[c] for c in names] + [StructField(c, k) for c, k in zip(ADDED, kinds)])
    return docs.select(*names).mapInArrow(partial(_cut_batches, names=names, pattern=pattern, rate=rate, spm=spm), schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of, from the output and its form alone."""
    # each sentinel occurs once: the text held none, and what stands before a sentinel meets its '<'
    body = F.substring(output, F.lit(len(PREFIX) + 1), F.length(output))

    def parts(second: str) -> tuple[Column, Column, Column]:
        head = F.substring_index(body, second, 1)
        tail = F.substring(body, F.length(head) + len(second) + 1, F.length(body))
        mid = F.substring_index(tail, MIDDLE, 1)
        return head, mid, F.substring(tail, F.length(mid) + len(MIDDLE) + 1, F.length(tail))

    prefix, suffix, middle = parts(SUFFIX)
    suffix_, prefix_, middle_ = parts(PREFIX)
    return F.when(form == "psm", F.concat(prefix, middle, suffix)).when(form == "spm", F.concat(prefix_, middle_, suffix_)).otherwise(output)
