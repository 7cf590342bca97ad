"""Language identification by segmentation-marginalised unigrams.

The pieces of a fixed public vocabulary have a probability per language. A text's likelihood under a language
is the product over its words of the sum over all ways to cut the word into pieces, worked out by the forward
algorithm. The probabilities are learned by expectation-maximisation (forward-backward) from the counts of
(language, word) over all training rows, which Spark sums; tasks send expected piece counts, so the driver only
ever holds one number per piece and language.

Words are lower-cased runs of letters, digits and non-ASCII characters; a word longer than CUT characters is cut there. Characters
without a piece get a fixed small probability.

Nulls, ties and odd rows: a null text, and one without a letter, is ``und`` with score 0; rows without a language
are not learned from; with nothing to learn from all rows are ``und``; ties go to the first language in code point
order; repeated rows get equal results; the columns lang, source and doc_id are never inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.words import GOLDEN, MIX_1, groups, letters_and_digits, texts_of, word_hashes
from tastegrid.session import settle

#: Characters of one lattice; rounds of learning; added to each expected count; likelihood of an unknown character.
CUT, ROUNDS, SMOOTHING, UNKNOWN = 32, 2, 0.1, 1e-8
#: Words whose likelihoods a task keeps; bytes of text of one step.
KEPT, STEP_BYTES = 300_000, 1 << 22
UNDETERMINED = "und"


def vocabulary_pieces(path: str) -> list[str]:
    """The lower-case text pieces of a sentencepiece vocabulary, without control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    return sorted({p for p in kept if p == p.lower()})


class PieceIndex:
    """Finds all pieces at all places of many words at once, by hashes of their code points."""

    BITS = 20

    def __init__(self, pieces: list[str]):
        self.longest = max(map(len, pieces), default=0)
        self.keys = np.zeros(len(pieces) + 1, np.uint64)
        for k, piece in enumerate(pieces, 1):
            for c in piece:
                self.keys[k : k + 1] = self.step(self.keys[k : k + 1], np.array([ord(c)], np.uint32))
        left, self.tables = np.arange(1, len(pieces) + 1, dtype=np.int32), []
        while len(left):  # pieces that share a slot move on to the next, smaller table
            bits = self.BITS - 4 * len(self.tables)
            table = np.zeros(1 << bits, np.int32)
            slots = self.slot(self.keys[left], bits)
            table[slots] = left
            self.tables.append((bits, table))
            left = left[table[slots] != left]

    @staticmethod
    def step(key: np.ndarray, code: np.ndarray) -> np.ndarray:
        return (key ^ (code.astype(np.uint64) + np.uint64(1))) * np.uint64(GOLDEN) + (key >> np.uint64(29))

    @staticmethod
    def slot(key: np.ndarray, bits: int) -> np.ndarray:
        return ((key ^ (key >> np.uint64(32))) * np.uint64(MIX_1)) >> np.uint64(64 - bits)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Piece number per key, 0 where there is none."""
        flat = keys.ravel()
        out, asked, slots = np.zeros(len(flat), np.int32), None, flat
        for bits, table in self.tables:
            at = table[self.slot(slots, bits)]
            taken = np.flatnonzero(at)
            at, slots = at[taken], slots[taken]
            asked = taken if asked is None else asked[taken]
            same = self.keys[at] == slots
            out[asked[same]] = at[same]
            asked, slots = asked[~same], slots[~same]  # a piece in a later table shares its slot in this one
        return out.reshape(keys.shape)

    def matches(self, codes: np.ndarray) -> list[np.ndarray]:
        """For each length k the piece that covers places i..i+k-1 of a word, as [word, i]."""
        out, key = [], np.zeros(codes.shape, np.uint64)
        for k in range(1, min(self.longest, codes.shape[1]) + 1):
            key = self.step(key[:, : codes.shape[1] - k + 1], codes[:, k - 1 :])
            found = self.find(key)
            found[codes[:, k - 1 :] == 0] = 0
            out.append(found)
        return out


class Lattice:
    """All pieces at all places of a list of words, ready for forward and backward passes.

    Row 0 of the probabilities is the unknown character: a character without a piece of its own.
    """

    def __init__(self, words: list[str], index: PieceIndex):
        self.sizes = np.array([len(w) for w in words], dtype=np.int64)
        width = int(self.sizes.max(initial=1))
        text = "".join(w.ljust(width, "\0") for w in words)
        self.codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, width)
        self.edges = []  # (begin, length, words, pieces)
        for k, found in enumerate(index.matches(self.codes), 1):
            for begin in range(found.shape[1]):
                here = found[:, begin]
                at = np.flatnonzero(here > 0) if k > 1 else np.flatnonzero(self.codes[:, begin] != 0)
                if len(at):
                    self.edges.append((begin, k, at, here[at]))

    def forward(self, p: np.ndarray) -> np.ndarray:
        """alpha[place, word, language]: all ways to reach a place."""
        out = np.zeros((self.codes.shape[1] + 1, len(self.sizes), p.shape[1]))
        out[0] = 1.0
        for begin, k, at, piece in sorted(self.edges, key=lambda e: e[0]):
            out[begin + k, at] += out[begin, at] * p[piece]
        return out

    def backward(self, p: np.ndarray) -> np.ndarray:
        """beta[place, word, language]: all ways from a place to the word's end."""
        out = np.zeros((self.codes.shape[1] + 1, len(self.sizes), p.shape[1]))
        out[self.sizes, np.arange(len(self.sizes))] = 1.0
        for begin, k, at, piece in sorted(self.edges, key=lambda e: -e[0]):
            out[begin, at] += out[begin + k, at] * p[piece]
        return out

    def whole(self, alpha: np.ndarray) -> np.ndarray:
        """Likelihood of each word."""
        return alpha[self.sizes, np.arange(len(self.sizes))]


def by_size(parts: list[str]) -> Iterator[np.ndarray]:
    """Numbers of the words in steps of words of like length."""
    order = np.argsort([len(w) for w in parts], kind="stable")
    for first in range(0, len(order), 8192):
        yield order[first : first + 8192]


def cut_words(words: list[str]) -> tuple[list[str], np.ndarray]:
    """The lattice strings of words (a word mark before each, cut at CUT characters) and their word numbers."""
    parts, owner = [], []
    for k, word in enumerate(words):
        marked = "▁" + word.lower()
        for i in range(0, len(marked), CUT):
            parts.append(marked[i : i + CUT])
            owner.append(k)
    return parts, np.array(owner, dtype=np.int64)


def _words_of(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """(different hashes, number per word, words before each text, each different word in lower case)."""
    inside = letters_and_digits()
    hashes, before, starts = word_hashes(raw, bounds, True, inside)
    different, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    base = int(bounds[0])
    text = raw[base : int(bounds[-1])]
    # a word ends where its bytes or its text end
    last = inside[text]
    edge = (bounds - base)[1:]
    edge = edge[edge > 0] - 1
    at_edge = last[edge]
    last[:-1] &= ~last[1:]
    last[edge] = at_edge
    ends = np.flatnonzero(last) + 1
    stops = ends[np.searchsorted(ends, starts[first], side="right")] if len(first) else first
    view = memoryview(text)
    return different, number, before, [str(view[a:b], "utf-8", "replace").lower() for a, b in zip(starts[first].tolist(), stops.tolist())]


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, bounds = texts_of(batch.column(0))
        langs = batch.column(1).to_pylist()
        names = sorted(set(langs))
        code = np.searchsorted(names, langs)
        for i, j in groups(bounds, STEP_BYTES):
            _, number, before, words = _words_of(raw, bounds[i : j + 1])
            if not len(words):
                continue
            lang = np.repeat(code[i:j], np.diff(before))
            key, n = np.unique(lang * len(words) + number, return_counts=True)
            texts = np.array(words, dtype=object)
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[k] for k in (key // len(words)).tolist()], pa.string()), pa.array(texts[key % len(words)], pa.string()), pa.array(n, pa.int64())],
                ["lang", "word", "n"],
            )


def _expected(batches: Iterator[pa.RecordBatch], shared, langs: list[str], p: np.ndarray) -> Iterator[pa.RecordBatch]:
    index = shared.value
    sums = np.zeros_like(p)
    for batch in batches:
        lang = np.searchsorted(langs, batch.column(0).to_pylist())
        weight = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
        parts, owner = cut_words(batch.column(1).to_pylist())
        own_lang, own_weight = lang[owner], weight[owner]
        for l in np.unique(own_lang):
            mine = np.flatnonzero(own_lang == l)
            some_parts, q = [parts[i] for i in mine], p[:, l : l + 1]
            for some in by_size(some_parts):
                lattice = Lattice([some_parts[i] for i in some], index)
                alpha, beta = lattice.forward(q)[:, :, 0], lattice.backward(q)[:, :, 0]
                scale = own_weight[mine[some]] / beta[0]
                for begin, k, at, piece in lattice.edges:
                    share = alpha[begin, at] * q[piece, 0] * beta[begin + k, at] * scale[at]
                    np.add.at(sums[:, l], piece, share)
    k, l = np.nonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(l), pa.array(sums[k, l])], ["piece", "lang", "n"])


class LanguageModel:
    """Piece probabilities per language; row 0 is the unknown character."""

    def __init__(self, pieces: list[str], langs: list[str], p: np.ndarray):
        self.pieces, self.langs, self.p = pieces, langs, p


def train(rows: DataFrame, pieces: list[str], rounds: int = ROUNDS) -> LanguageModel:
    """Learns from all (text, lang) rows with a language."""
    spark = rows.sparkSession
    known = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    counts = settle(
        known.mapInArrow(_word_counts, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    )
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    shared = spark.sparkContext.broadcast(PieceIndex(pieces))  # of fixed size: a vocabulary
    p = np.full((len(pieces) + 1, len(langs)), 1 / max(len(pieces), 1))
    p[0] = UNKNOWN
    for _ in range(rounds if langs else 0):
        found = (
            counts.mapInArrow(partial(_expected, shared=shared, langs=langs, p=p), "piece bigint, lang bigint, n double")
            .groupBy("piece", "lang")
            .agg(F.sum("n").alias("n"))
            .toPandas()
        )
        sums = np.full(p.shape, SMOOTHING)
        np.add.at(sums, (found["piece"].to_numpy(), found["lang"].to_numpy()), found["n"].to_numpy())
        p = np.maximum(sums / sums[1:].sum(0), UNKNOWN)
        p[0] = UNKNOWN
    return LanguageModel(pieces, langs, p)


def _predict(batches: Iterator[pa.RecordBatch], shared, langs: list[str], p: np.ndarray) -> Iterator[pa.RecordBatch]:
    index = shared.value
    names = np.array([*langs, UNDETERMINED], dtype=object)
    hashes, values = np.zeros(0, np.uint64), np.zeros((0, len(langs) + 1))

    def learned(words: list[str]) -> np.ndarray:
        """Log likelihood per language and whether the word has a letter."""
        out = np.zeros((len(words), len(langs) + 1))
        out[:, -1] = [w.isalpha() or any(map(str.isalpha, w)) for w in words]
        parts, owner = cut_words(words)
        for some in by_size(parts):
            lattice = Lattice([parts[i] for i in some], index)
            np.add.at(out, (owner[some], slice(None, -1)), np.log(lattice.whole(lattice.forward(p))))
        return out

    for batch in batches:
        raw, bounds = texts_of(batch.column(1))
        best, score = [], []
        for i, j in groups(bounds, STEP_BYTES):
            different, number, before, words = _words_of(raw, bounds[i : j + 1])
            if len(hashes) > KEPT:
                hashes, values = hashes[:0], values[:0]
            new = np.flatnonzero(~np.isin(different, hashes, assume_unique=True))
            if len(new):
                grown = np.concatenate([hashes, different[new]])
                order = np.argsort(grown)
                values = np.concatenate([values, learned([words[k] for k in new])])[order]
                hashes = grown[order]
            each = values[np.searchsorted(hashes, different)][number]
            sums = np.concatenate([np.zeros((1, len(langs) + 1)), np.cumsum(each, axis=0)])[before]
            total = np.diff(sums, axis=0)
            if langs:
                top = total[:, :-1].argmax(1)
                odds = np.exp(np.minimum(total[:, :-1] - total[np.arange(len(top)), top][:, None], 0)).sum(1)
            else:
                top, odds = np.zeros(j - i, np.int64), np.ones(j - i)
            some = total[:, -1] > 0.5
            best.append(np.where(some, top, len(langs)))
            score.append(np.where(some & bool(langs), 1 / odds, 0.0))
        chosen = np.concatenate(best) if best else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(names[chosen], pa.string()), pa.array(np.concatenate(score) if score else np.zeros(0))],
            ["doc_id", "held_out", "lang_pred", "score"],
        )


def predict(rows: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred, score from (doc_id, text, held_out) rows."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(PieceIndex(model.pieces))
    return rows.select("doc_id", "text", "held_out").mapInArrow(
        partial(_predict, shared=shared, langs=model.langs, p=model.p),
        f"doc_id {kind}, held_out boolean, lang_pred string, score double",
    )
