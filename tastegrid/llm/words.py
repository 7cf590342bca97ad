"""Vectorised word and shingle hashing over the UTF-8 bytes of whole texts.

A word is a maximal run of bytes outside space, tab, line feed, vertical tab, form feed and carriage
return. The kernels work on one flat byte array per group of texts, so no Python loop runs over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one kernel call takes; a longer single text is a call of its own.
GROUP_BYTES = 1 << 20

#: Scripts without spaces: Thai, Lao, Tibetan, Myanmar, Khmer, kana, bopomofo, ideographs, half-width kana.
UNSPACED = ((0xE00, 0xFFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x312F), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F))

# fixed values: the white space of a word boundary, odd multipliers of the 64-bit mixing steps
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
MIX_1, MIX_2, GOLDEN = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(GOLDEN)
    x ^= x >> np.uint64(30)
    x *= np.uint64(MIX_1)
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX_2)
    x ^= x >> np.uint64(31)
    return x


def byte_values(fold: bool) -> np.ndarray:
    """A 64-bit value per byte, none for white space; with ``fold`` A-Z share the values of a-z."""
    order = np.arange(256, dtype=np.uint64)
    if fold:
        order[65:91] += np.uint64(32)
    values = mix(order + np.uint64(1))
    values[list(SPACES)] = 0
    return values


def texts_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; a null text has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, bounds


def groups(bounds: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes."""
    first, n = 0, len(bounds) - 1
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def letters_and_digits() -> np.ndarray:
    """Bytes inside a word where punctuation parts words too: ASCII letters and digits, and all of non-ASCII."""
    inside = np.zeros(256, dtype=bool)
    inside[48:58] = inside[65:91] = inside[97:123] = inside[128:] = True
    return inside


def not_space() -> np.ndarray:
    """Bytes inside a word where only white space parts words."""
    inside = np.ones(256, dtype=bool)
    inside[list(SPACES)] = False
    return inside


def unspaced(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, bytes) of the characters of scripts that put no space between words."""
    at = np.flatnonzero(text >= 0xE0)
    at = at[at < len(text) - 2]
    lead, second = text[at], text[at + 1]
    code = ((lead.astype(np.int64) & 15) << 12) | ((second.astype(np.int64) & 63) << 6) | (text[at + 2] & 63)
    found = np.zeros(len(at), bool)
    for first, last in UNSPACED:
        found |= (code >= first) & (code <= last)
    found &= lead < 0xF0
    wide = (lead == 0xF0) & (second >= 0xA0)  # ideographs from U+20000 on
    return at[found | wide], np.where(wide, 4, 3)[found | wide]


def word_hashes(
    raw: np.ndarray, bounds: np.ndarray, fold: bool, inside: np.ndarray | None = None, apart: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash per word, words before each text, start byte of each word) of the texts at ``bounds``.

    With ``apart`` each character of an unspaced script is a word.
    """
    inside = not_space() if inside is None else inside
    base, end = int(bounds[0]), int(bounds[-1])
    text = raw[base:end]
    ends = bounds - base
    if not len(text):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64), np.zeros(0, np.int64)
    letter = inside[text]
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    firsts = ends[:-1][ends[:-1] < len(text)]
    begins[firsts] |= letter[firsts]
    if apart:
        at, width = unspaced(text)
        begins[at] = True
        following = (at + width)[at + width < len(text)]
        begins[following] |= letter[following]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64), starts
    lengths = np.diff(starts, append=len(text))
    head = int(starts[0])
    place = np.arange(head, len(text), dtype=np.int32) - np.repeat(starts.astype(np.int32), lengths)
    powers = mix(np.arange(int(lengths.max()) + 1, dtype=np.uint64)) | np.uint64(1)
    values = byte_values(fold)
    values[~inside] = 0
    weighed = values[text[head:]]
    weighed *= powers[place]
    sums = np.add.reduceat(weighed, starts - head)
    before = np.searchsorted(starts, ends)
    return mix(sums), before, starts


def shingle_hashes(hashes: np.ndarray, before: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash per shingle, shingles before each text): runs of ``width`` words inside one text.

    A text of fewer words has its whole sequence as its one shingle; a text without words has none.
    """
    counts = np.diff(before)
    whole = np.maximum(counts - width + 1, 0)
    short = (counts > 0) & (counts < width)
    made = whole + short
    after = np.concatenate([[0], np.cumsum(made)])
    out = np.zeros(int(after[-1]), np.uint64)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    if len(hashes) >= width:
        n = len(hashes) - width + 1
        rolled = np.zeros(n, np.uint64)
        for k in range(width):
            rolled += hashes[k : k + n] * factors[k]
        rolled = mix(rolled + np.uint64(width))
        valid = np.ones(len(hashes), bool)  # a start is valid unless its run leaves the text
        for k in range(1, width):
            last = before[1:] - k
            last = last[last >= before[:-1]]
            valid[last] = False
        at = np.ones(len(out), bool)
        at[after[:-1][short]] = False
        out[at] = rolled[valid[:n]]
    for i in np.flatnonzero(short):
        own = hashes[before[i] : before[i + 1]]
        out[after[i]] = mix(np.array([(own * factors[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))], np.uint64))[0]
    return out, after


def distinct_per_text(values: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values sorted and distinct inside each text, values before each text)."""
    values = values.copy()
    for first, last in zip(after[:-1].tolist(), after[1:].tolist()):
        values[first:last].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[after[:-1][np.diff(after) > 0]] = True
    return values[keep], np.concatenate([[0], np.cumsum(keep)])[after]
