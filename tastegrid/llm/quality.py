"""Quality classifier: a generalised additive model with pairwise interactions.

Texts become a dozen surface features. Cyclic boosting fits shallow trees of one feature at a time to the
logistic residual, in turn over all features, and then trees of two features for the pairs that reduce the
residual most. Every tree only adds to a lookup table over the feature's bins (or a pair's bins), so a score
is a sum of table entries and its parts can be read off.

The fit takes a bounded sample: the ``sample`` labelled rows with the smallest hash of their doc_id. Only
numbers of that sample reach the driver. Features and scores cover all rows and whole texts.

Nulls, ties and odd rows: a null text has the features of an empty one; rows without a label, or with a null
one, are not learned from; without any label of both kinds all scores are the share of ones (0.5 without
labels); repeated rows get equal scores; columns of the table beside text are never inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.words import distinct_per_text, groups, shingle_hashes, texts_of, word_hashes

#: Labelled rows of a fit; bins of a feature, bins of a feature in a pair; passes; pairs; learning rate.
SAMPLE, BINS, PAIR_BINS, PASSES, PAIRS, RATE = 20_000, 32, 8, 60, 6, 0.25
#: Least rows of a leaf, and the pull of leaf values towards zero.
LEAF, PULL = 20, 1.0

FEATURES = (
    "words", "word_bytes", "upper", "digits", "symbols", "bars", "marks", "wide",
    "repeats_last", "distinct_words", "distinct_shingles", "words_per_line", "stops", "same_lines",
)


def _class_sums(text: np.ndarray, ends: np.ndarray, kinds: list[np.ndarray]) -> list[np.ndarray]:
    """Bytes of each kind per text."""
    out = []
    for kind in kinds:
        at = np.flatnonzero(kind[text])
        out.append(np.diff(np.searchsorted(at, ends)).astype(float))
    return out


def _table(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for first, last in ranges:
        out[first : last + 1] = True
    return out


def features(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of FEATURES per text."""
    made = [_group_features(raw, bounds[i : j + 1]) for i, j in groups(bounds)]
    return np.concatenate(made) if made else np.zeros((0, len(FEATURES)))


def _group_features(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    text, ends = raw[int(bounds[0]) : int(bounds[-1])], bounds - bounds[0]
    size = np.maximum(np.diff(ends), 1).astype(float)
    upper, lower, digits, symbols, bars, marks, wide, breaks, stops = _class_sums(
        text, ends,
        [
            _table((65, 90)), _table((97, 122)), _table((48, 57)),
            _table((33, 38), (40, 43), (47, 47), (60, 62), (64, 64), (91, 96), (123, 126)),
            _table((124, 124)), _table((33, 33), (63, 63)), _table((128, 255)), _table((10, 10)), _table((44, 44), (46, 46)),
        ],
    )
    hashes, before, _ = word_hashes(raw, bounds, False)
    n = np.diff(before).astype(float)
    some = np.maximum(n, 1)
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[before[:-1][before[:-1] < len(hashes)]] = False
    repeats = np.diff(np.concatenate([[0], np.cumsum(same)])[before])
    _, words_after = distinct_per_text(hashes, before)
    shingles, after = shingle_hashes(hashes, before, 3)
    _, shingles_after = distinct_per_text(shingles, after)
    line = _table(*[(b, b) for b in range(256) if b != 10])
    lines, lines_before, _ = word_hashes(raw, bounds, False, line)
    _, lines_after = distinct_per_text(lines, lines_before)
    columns = [
        np.log1p(n), size / some, upper / np.maximum(upper + lower, 1), digits / size, symbols / size, bars / some, marks / some,
        wide / size, repeats / some, np.diff(words_after) / some, np.diff(shingles_after) / np.maximum(np.diff(after), 1),
        n / (breaks + 1), stops / some, 1 - np.diff(lines_after) / np.maximum(np.diff(lines_before), 1),
    ]
    return np.stack(columns, axis=1)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = features(*texts_of(batch.column(1)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(x[:, k]) for k in range(len(FEATURES))]], ["doc_id", *FEATURES]
        )


def with_features(docs: DataFrame) -> DataFrame:
    """doc_id and FEATURES of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _feature_rows, f"doc_id {kind}, " + ", ".join(f"{f} double" for f in FEATURES)
    )


class AdditiveModel:
    """Lookup tables over binned features and pairs of features; scores are sums of their entries."""

    def __init__(self, edges: list[np.ndarray], intercept: float):
        self.edges, self.intercept = edges, intercept
        self.tables = [np.zeros(len(e) + 1) for e in edges]
        self.pairs: list[tuple[int, int, np.ndarray]] = []

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(self.edges)], axis=1)

    def coarse(self, bins: np.ndarray, k: int) -> np.ndarray:
        return bins[:, k] * PAIR_BINS // len(self.tables[k])

    def margin(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), self.intercept)
        for k, table in enumerate(self.tables):
            total += table[bins[:, k]]
        for j, k, table in self.pairs:
            total += table[self.coarse(bins, j), self.coarse(bins, k)]
        return total

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(self.bins(x)), -30, 30)))


def _leaf(gradient: float, weight: float) -> float:
    return gradient / (weight + PULL)


def _split(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """(gain, bin behind which to cut) of the best cut along a histogram, gain 0 without one."""
    left_g, left_h, left_n = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    right_g, right_h, right_n = g.sum() - left_g, h.sum() - left_h, n.sum() - left_n
    gain = left_g**2 / (left_h + PULL) + right_g**2 / (right_h + PULL) - g.sum() ** 2 / (h.sum() + PULL)
    gain[(left_n < LEAF) | (right_n < LEAF)] = 0
    if not len(gain) or gain.max() <= 1e-9:
        return 0.0, -1
    return float(gain.max()), int(gain.argmax())


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int) -> np.ndarray:
    """Leaf value per bin of a tree over one feature's histogram."""
    gain, cut = _split(g, h, n) if depth else (0.0, -1)
    if cut < 0:
        return np.full(len(g), _leaf(g.sum(), h.sum()))
    parts = (slice(None, cut + 1), slice(cut + 1, None))
    return np.concatenate([_tree(g[p], h[p], n[p], depth - 1) for p in parts])


def _pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, table) of a tree that cuts one feature and then each side along the other."""
    best, table = 0.0, np.zeros_like(g)
    whole = g.sum() ** 2 / (h.sum() + PULL)
    for cut in range(g.shape[0] - 1):
        gain, out = -whole, np.zeros_like(g)
        for side in (slice(None, cut + 1), slice(cut + 1, None)):
            column = g[side].sum(0), h[side].sum(0), n[side].sum(0)
            values = _tree(*column, 1)
            out[side] = values
            _, at = _split(*column)
            spans = (slice(None, at + 1), slice(at + 1, None)) if at >= 0 else (slice(None),)
            gain += sum(column[0][s].sum() ** 2 / (column[1][s].sum() + PULL) for s in spans)
        if gain > best:
            best, table = gain, out
    return best, table


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting of one-feature trees, then of the best pairs, by logistic loss."""
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    edges = [np.unique(np.quantile(x[:, k], np.arange(1, BINS) / BINS)) if len(y) else np.zeros(0) for k in range(x.shape[1])]
    model = AdditiveModel(edges, float(np.log(share / (1 - share))))
    if len(y) < 2 * LEAF or y.min() == y.max():
        return model
    bins = model.bins(x)
    total = np.full(len(y), model.intercept)

    def residual() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(PASSES):
        for k, table in enumerate(model.tables):
            g, h = residual()
            sums = [np.bincount(bins[:, k], w, len(table)) for w in (g, h, np.ones(len(y)))]
            step = RATE * _tree(*sums, 2)
            table += step
            total += step[bins[:, k]]
    coarse = [model.coarse(bins, k) for k in range(len(edges))]

    def grid(j: int, k: int) -> list[np.ndarray]:
        g, h = residual()
        cell = coarse[j] * PAIR_BINS + coarse[k]
        return [np.bincount(cell, w, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS) for w in (g, h, np.ones(len(y)))]

    ranked = sorted(((_pair_tree(*grid(j, k))[0], j, k) for j in range(len(edges)) for k in range(j)), reverse=True)
    model.pairs = [(j, k, np.zeros((PAIR_BINS, PAIR_BINS))) for gain, j, k in ranked[:PAIRS] if gain > 0]
    for _ in range(PASSES // 4):
        for j, k, table in model.pairs:
            step = RATE * _pair_tree(*grid(j, k))[1]
            table += step
            total += step[coarse[j], coarse[k]]
    return model


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the doc_id as text, modulo ``parts``; a null doc_id counts as 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts, F.lit(0))


def train(featured: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> AdditiveModel:
    """Fits on at most ``sample`` labelled rows of ``featured`` (doc_id, FEATURES), those with the smallest hashes.

    Of more than four times as many labels only the share with small hashes takes part, so what tasks send for
    the choice does not grow with the table either.
    """
    known = labels.where(F.col("quality").isNotNull()).select("doc_id", F.col("quality").cast("double").alias("_y"))
    known = known.withColumn("_h", F.xxhash64("doc_id"))
    share = min(1.0, 4 * sample / max(known.count(), 1))
    if share < 1:
        known = known.where(F.pmod("_h", F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = (
        featured.join(known, "doc_id")
        .orderBy("_h", "doc_id", "_y", *FEATURES)
        .limit(sample)
        .select("_y", *FEATURES)
        .toPandas()
    )
    x = rows[list(FEATURES)].to_numpy(dtype=float).reshape(-1, len(FEATURES))
    return fit(x, rows["_y"].to_numpy(dtype=float))


def _score_features(batches: Iterator[pa.RecordBatch], model: AdditiveModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = np.stack([batch.column(f).to_numpy(zero_copy_only=False) for f in FEATURES], axis=1)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.predict(x))], ["doc_id", "score"])


def score_features(featured: DataFrame, model: AdditiveModel) -> DataFrame:
    """doc_id, score, predicted of rows that already have FEATURES."""
    kind = featured.schema["doc_id"].dataType.simpleString()
    scored = featured.select("doc_id", *FEATURES).mapInArrow(partial(_score_features, model=model), f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _keep(batches: Iterator[pa.RecordBatch], model: AdditiveModel, at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array(model.predict(features(*texts_of(batch.column(at)))) >= 0.5))


def keep_good(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """The rows of ``docs`` whose text the model takes for quality 1, all columns as they came."""
    return docs.mapInArrow(partial(_keep, model=model, at=docs.columns.index("text")), docs.schema)
