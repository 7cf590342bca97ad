"""TF-IDF in long form: (id, term, weight)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegrid.functions.binding import let

# fixed values: English function words left out of the vocabulary (own list)
STOP_WORDS = (
    "a about above after again against all also am an and any are as at be because been before being below between "
    "both but by can could did do does doing down during each few for from further had has have having he her here "
    "hers herself him himself his how i if in into is it its itself just me more most my myself no nor not now of off "
    "on once only or other our ours ourselves out over own same she should so some such than that the their theirs "
    "them themselves then there these they this those through to too under until up very was we were what when where "
    "which while who whom why will with would you your yours yourself yourselves"
).split()
MAX_FEATURES = 1000
MIN_LETTERS = 2


def _runs(text: Column) -> Column:
    """Lower-cased word runs; accented letters are letters, anything else splits."""
    return F.split(F.lower(text), r"[^\p{L}\p{N}_]+")


def tokens(text: Column) -> Column:
    """Lower-cased word runs of two or more characters, stop words removed."""
    return F.filter(_runs(text), lambda t: (F.length(t) >= MIN_LETTERS) & ~t.isin(*STOP_WORDS))


def _with_pairs(found: Column) -> Column:
    """Tokens and neighbouring pairs."""

    def joined(t: Column) -> Column:
        shorter = F.greatest(F.size(t) - 1, F.lit(0))
        left, right = F.slice(t, F.lit(1), shorter), F.slice(t, F.lit(2), shorter)
        return F.concat(t, F.zip_with(left, right, lambda a, b: F.concat(a, F.lit(" "), b)))

    return let(found, joined)


def item_content(genre: Column, plot: Column, title: Column) -> Column:
    return F.concat(
        F.coalesce(genre, F.lit("")), F.lit(" "), F.coalesce(plot, F.lit("")), F.lit(" "), F.coalesce(title, F.lit(""))
    )


def doc_terms(docs: DataFrame, text: str, id_col: str = "id") -> DataFrame:
    """id, terms: the tokens and neighbouring pairs of each document, one row per document."""
    return docs.select(id_col, _with_pairs(tokens(F.col(text))).alias("terms"))


def term_sums(terms: DataFrame) -> DataFrame:
    """term, total, df in one shuffle of partial sums: all occurrences, and one per document."""
    every = F.transform("terms", lambda t: F.struct(t.alias("term"), F.lit(1).alias("n"), F.lit(0).alias("d")))
    once = F.transform(F.array_distinct("terms"), lambda t: F.struct(t.alias("term"), F.lit(0).alias("n"), F.lit(1).alias("d")))
    return (
        terms.select(F.explode(F.concat(every, once)).alias("x"))
        .groupBy(F.col("x.term").alias("term"))
        .agg(F.sum("x.n").alias("total"), F.sum("x.d").alias("df"))
    )


def term_totals(terms: DataFrame) -> DataFrame:
    """term, total alone: half the rows of ``term_sums``."""
    return terms.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("total"))


def term_documents(terms: DataFrame) -> DataFrame:
    """term, df alone."""
    return terms.select(F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def vocabulary_topn(sums: DataFrame, n: int = MAX_FEATURES) -> DataFrame:
    """The n terms with the largest total count, ties by term."""
    return sums.orderBy(F.desc("total"), "term").limit(n).select("term", "total")


def _idf(n: Column) -> Column:
    return F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + 1.0


def doc_frequency(sums: DataFrame, n_docs: int | Column) -> DataFrame:
    """term, df, idf = ln((1 + n) / (1 + df)) + 1 from a table with df per term."""
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    return sums.select("term", "df", _idf(n).alias("idf"))


def fit_tfidf(docs: DataFrame, text: str, id_col: str = "id", max_features: int = MAX_FEATURES) -> DataFrame:
    """id, term, weight: tf * idf over the kept vocabulary, each document scaled to unit length.

    A document is one row: its terms are counted and scaled inside the row, only the sums per term cross the
    network. The vocabulary has at most ``max_features`` rows, so what travels to the tasks does not grow.
    """
    terms = doc_terms(docs, text, id_col)
    kept = (
        term_sums(terms)
        .orderBy(F.desc("total"), "term")
        .limit(max_features)
        .select("term", _idf(F.lit(docs.count())).alias("idf"))
        .collect()
    )
    shared = docs.sparkSession.sparkContext.broadcast(([r["term"] for r in kept], np.array([r["idf"] for r in kept])))

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, idf = shared.value
        names = pa.array(vocabulary, pa.string())
        for b in batches:
            found = pc.index_in(b.column(1).flatten(), value_set=names)
            row = np.repeat(np.arange(b.num_rows), b.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            known = found.is_valid().to_numpy(zero_copy_only=False)
            slot = found.fill_null(0).to_numpy(zero_copy_only=False)[known]
            key, tf = np.unique(row[known] * max(len(idf), 1) + slot, return_counts=True)
            row, slot = key // max(len(idf), 1), key % max(len(idf), 1)
            weight = tf * idf[slot]
            length = np.sqrt(np.bincount(row, weight * weight, b.num_rows))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row)), names.take(pa.array(slot)), pa.array(weight / length[row])], [id_col, "term", "weight"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return terms.mapInArrow(scale, f"`{id_col}` {kind}, term string, weight double")


def term_counts(docs: DataFrame, text: str, id_col: str = "id") -> DataFrame:
    """id, term, tf: the ``tokens`` of each row counted in its own task, without a shuffle; rows of equal ids are counted apart."""
    kind = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stop = pa.array(STOP_WORDS, pa.string())
        for b in batches:
            found = b.column(1).flatten().dictionary_encode()
            names, slot = found.dictionary, found.indices.to_numpy(zero_copy_only=False)
            kept = pc.and_(pc.greater_equal(pc.utf8_length(names), MIN_LETTERS), pc.invert(pc.is_in(names, value_set=stop)))
            row = np.repeat(np.arange(b.num_rows), b.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            known = kept.to_numpy(zero_copy_only=False)[slot]
            many = max(len(names), 1)
            key, tf = np.unique(row[known] * many + slot[known], return_counts=True)
            columns = [b.column(0).take(pa.array(key // many)), names.take(pa.array(key % many)), pa.array(tf)]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "term", "tf"])

    return docs.select(id_col, _runs(F.col(text)).alias("runs")).mapInArrow(count, f"`{id_col}` {kind}, term string, tf long")


def hashed_vectors(docs: DataFrame, text: str, id_col: str = "id", dim: int = 384) -> DataFrame:
    """id, bucket, weight: TF-IDF folded into ``dim`` md5 buckets, unit length (the offline text embedding)."""
    counts = term_counts(docs, text, id_col)
    n_docs, n_ids = docs.agg(F.count(F.lit(1)), F.countDistinct(id_col)).first()
    if n_ids < n_docs:  # rows of one id are one document
        counts = counts.groupBy(id_col, "term").agg(F.sum("tf").alias("tf"))
    by_term = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    freq = doc_frequency(by_term, n_docs).select(
        "term", "idf", (F.conv(F.substring(F.md5("term"), 1, 8), 16, 10).cast("long") % dim).cast("int").alias("bucket")
    )
    # dealt by document once, for the sums and for the length
    raw = (
        counts.join(freq, "term")
        .select(id_col, "bucket", "tf", "idf")
        .repartition(id_col)
        .groupBy(id_col, "bucket")
        .agg(F.sum(F.col("tf") * F.col("idf")).alias("_w"))
    )
    # a window group is one document's buckets: at most dim rows
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(id_col)))
    return raw.select(id_col, "bucket", (F.col("_w") / length).alias("weight"))


def dense(weights: DataFrame, id_col: str, slot: str, dim: int) -> DataFrame:
    """(id, slot, weight) rows to one ``array<double>`` of length ``dim`` per id (slots are 0-based)."""
    collected = weights.groupBy(id_col).agg(
        F.collect_list(F.col(slot).cast("int")).alias("_s"), F.collect_list("weight").alias("_w")
    )
    id_type = weights.schema[id_col].dataType.simpleString()

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slots, values = b.column(1), b.column(2)
            rows = np.repeat(np.arange(b.num_rows), np.diff(slots.offsets.to_numpy()))
            flat = np.zeros((b.num_rows, dim))
            flat[rows, slots.flatten().to_numpy()] = values.flatten().to_numpy()
            offsets = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * dim)
            vectors = pa.ListArray.from_arrays(offsets, pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), vectors], names=[id_col, "vector"])

    return collected.mapInArrow(scatter, f"`{id_col}` {id_type}, vector array<double>")


def sparse(weights: DataFrame, id_col: str, slot: str) -> DataFrame:
    """(id, slot, weight) rows to one struct<dense, slots, weights> per id, the kernel's sparse vector."""
    pairs = F.collect_list(F.struct(F.col(slot).cast("int").alias("s"), F.col("weight").alias("w")))
    return weights.groupBy(id_col).agg(pairs.alias("_p")).select(id_col, sparse_vector(F.col("_p")).alias("vector"))


def sparse_vector(pairs: Column, dense: Column | None = None) -> Column:
    """struct<dense, slots, weights> from an array of (s, w) pairs and an optional dense head."""
    empty = F.array().cast("array<double>")
    return F.struct(
        (empty if dense is None else dense).alias("dense"),
        F.coalesce(F.transform(pairs, lambda p: p["s"]), F.array().cast("array<int>")).alias("slots"),
        F.coalesce(F.transform(pairs, lambda p: p["w"]), empty).alias("weights"),
    )
