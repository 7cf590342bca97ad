"""Document search: filters, vectors, keywords, cells."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import zip_longest

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tastegrid.functions.hashing import digest_vector
from tastegrid.functions.text import keyword_score
from tastegrid.functions.vectors import l2_normalize
from tastegrid.operators.cleaning import match_filters
from tastegrid.operators.nearest import topk_in_cells, topk_inner_product
from tastegrid.session import settle, spread, written

# fixed values
OVERFETCH = 3
RERANK_POOL = 2
KEYWORD_WEIGHT = 0.3
MIN_SCORE = 0.1
FLAT_LIMIT = 10_000
MAX_CELLS = 100
HIT_COLUMNS = ["id", "title", "genre", "year", "rating", "director"]

# the digest embedding repeats after its 16 numbers, so those alone give the same cosines
_MODELS: dict[str, Callable] = {
    "digest": lambda text: l2_normalize(digest_vector(text)),
    "digest_core": lambda text: l2_normalize(digest_vector(text, 16)),
}


def register_embedding_model(name: str, embed: Callable) -> None:
    """Add a model: text column -> unit vector column (wrap a real model in an iterator pandas UDF)."""
    _MODELS[name] = embed


def embed_text(df: DataFrame, text: str, model: str = "digest", out: str = "vector") -> DataFrame:
    """Unit vector per row; the md5 fallback model needs no weights."""
    if model not in _MODELS:
        raise ValueError(f"unknown embedding model: {model}")
    return df.withColumn(out, _MODELS[model](F.col(text)))


def vector_topk(
    queries: DataFrame,
    docs: DataFrame,
    k: int = 5,
    filters: dict | None = None,
    min_score: float | None = MIN_SCORE,
    overfetch: int | None = None,
    query_id: str = "query_id",
    doc_id: str = "id",
    digits: int = 9,
) -> DataFrame:
    """query_id, doc_id, score (cosine), rank.

    Filters are applied before the search, so k rows are found where k exist. ``overfetch`` searches
    first and filters the best overfetch * k afterwards, which may leave fewer than k.
    """
    if filters and overfetch:
        hits = topk_inner_product(queries, docs, k * overfetch, query_id, doc_id, min_score=min_score, digits=digits)
        allowed = match_filters(docs, filters).select(doc_id)
        w = Window.partitionBy(query_id).orderBy("_was")
        kept = hits.withColumnRenamed("rank", "_was").join(allowed, doc_id, "left_semi")
        return kept.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).drop("_was")
    pool = match_filters(docs, filters) if filters else docs
    return topk_inner_product(queries, pool, k, query_id, doc_id, min_score=min_score, digits=digits)


def context_for_query(
    queries: DataFrame, docs: DataFrame, top_k: int = 5, min_score: float | None = MIN_SCORE, digits: int = 9
) -> DataFrame:
    """query_id, rank, relevance_score and the document fields; only k ids per query reach the join."""
    hits = vector_topk(queries, docs, top_k, min_score=min_score, digits=digits)
    fields = [c for c in ("title", "genre", "year", "rating", "director", "cast", "plot") if c in docs.columns]
    return hits.join(docs.select("id", *fields), "id").withColumnRenamed("score", "relevance_score")


def search_results(
    queries: DataFrame,
    docs: DataFrame,
    top_k: int = 10,
    filters: dict | None = None,
    min_score: float | None = MIN_SCORE,
    digits: int = 9,
) -> DataFrame:
    """The search response rows with ``total`` hits per query."""
    hits = vector_topk(queries, docs, top_k, filters or None, min_score, digits=digits)
    joined = hits.join(docs.select(*HIT_COLUMNS), "id")
    total = F.count(F.lit(1)).over(Window.partitionBy("query_id"))
    return joined.withColumnRenamed("score", "relevance_score").withColumn("total", total)


def similar_items(
    vectors: DataFrame,
    k: int = 5,
    id_col: str = "id",
    digits: int = 9,
    index: tuple[DataFrame, DataFrame] | None = None,
    nprobe: int = 1,
) -> DataFrame:
    """id, similar_id, score, rank for every item, itself left out by id.

    Without an index every item is compared with every other, exact and quadratic. With (documents,
    centroids) of ``ivf_build`` an item meets only its nearest cells, the way for large item tables.
    """
    left = vectors.select(F.col(id_col).alias("id"), "vector")
    if index is not None:
        stored, centroids = index
        right = stored.select(F.col(id_col).alias("similar_id"), "vector", "centroid")
        return ivf_search(left, right, centroids, k, nprobe, "id", "similar_id", exclude_same=True)
    right = vectors.select(F.col(id_col).alias("similar_id"), "vector")
    return topk_inner_product(left, right, k, "id", "similar_id", exclude_same=True, digits=digits)


def hybrid_rerank(candidates: DataFrame, k: int, keyword_weight: float = KEYWORD_WEIGHT, digits: int = 9) -> DataFrame:
    """Rescore candidates (query, text, semantic score) and keep the k best per query."""
    final = (1 - keyword_weight) * F.col("score") + keyword_weight * keyword_score(F.col("query"), F.col("_text"))
    w = Window.partitionBy("query_id").orderBy(F.desc("final_score"), F.asc("id"))
    return (
        candidates.withColumn("final_score", F.round(final, digits))
        .withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .select("query_id", "id", F.col("final_score").alias("score"), "rank")
    )


def hybrid_search(
    queries: DataFrame,
    docs: DataFrame,
    k: int = 5,
    keyword_weight: float = KEYWORD_WEIGHT,
    min_score: float | None = MIN_SCORE,
    digits: int = 9,
) -> DataFrame:
    """2k semantic candidates per query, rescored with the share of query terms in title, genre, director, plot."""
    pool = vector_topk(queries, docs, k * RERANK_POOL, min_score=min_score, digits=digits).drop("rank")
    text = F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in ("title", "genre", "director", "plot")]))
    candidates = pool.join(docs.select("id", text.alias("_text")), "id").join(queries.select("query_id", "query"), "query_id")
    return hybrid_rerank(candidates, k, keyword_weight, digits)


def cell_count(n_docs: int) -> int:
    """The published rule for callers who want it: 1 (flat) up to the flat limit, else min(100, n // 100)."""
    return 1 if n_docs <= FLAT_LIMIT else min(MAX_CELLS, n_docs // 100)


def ivf_build(docs: DataFrame, cells: int = 1, seed: int = 42, iterations: int = 10) -> tuple[DataFrame, DataFrame]:
    """(docs with ``centroid``, centroids(centroid, vector)): k-means cells over unit vectors.

    One cell, the default, is the exact flat index; whatever the size of the table, only the caller makes it
    approximate.
    """
    unit = docs.withColumn("vector", l2_normalize(F.col("vector")))
    spark = docs.sparkSession
    if cells <= 1:
        flat = spark.createDataFrame([], "centroid int, vector array<double>")
        return unit.withColumn("centroid", F.lit(0)), flat
    featured = unit.withColumn("_features", array_to_vector("vector"))
    model = KMeans(k=cells, seed=seed, maxIter=iterations, featuresCol="_features", predictionCol="centroid").fit(featured)
    centers = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]  # one row per cell
    return (
        model.transform(featured).drop("_features"),
        spark.createDataFrame(centers, "centroid int, vector array<double>"),
    )


def ivf_search(
    queries: DataFrame,
    indexed: DataFrame,
    centroids: DataFrame,
    k: int = 5,
    nprobe: int = 1,
    query_id: str = "query_id",
    doc_id: str = "id",
    exclude_same: bool = False,
    min_score: float | None = None,
) -> DataFrame:
    """Top-k among the documents of the nprobe nearest cells of each query.

    Cells are chosen by a matrix product in the tasks; the numbers of the probed cells (at most one per cell)
    then become a filter, so that of an index stored by cell only their folders are read.
    """
    centers = sorted((r["centroid"], r["vector"]) for r in centroids.collect())  # one row per cell
    if not centers:
        probes, pool = queries.withColumn("centroid", F.lit(0)), indexed
    else:
        probes = settle(nearest_cells(queries, centers, nprobe))
        probed = sorted(r["centroid"] for r in probes.select("centroid").distinct().collect())
        pool = indexed.where(F.col("centroid").isin(probed))
    return topk_in_cells(probes, pool, k, "centroid", query_id, doc_id, exclude_same=exclude_same, min_score=min_score)


def nearest_cells(queries: DataFrame, centers: list[tuple[int, list[float]]], nprobe: int) -> DataFrame:
    """``queries`` once per cell to probe, with its number in ``centroid``; ties go to the lower number."""
    numbers = np.array([c for c, _ in centers])
    shared = queries.sparkSession.sparkContext.broadcast(np.array([v for _, v in centers], dtype=np.float64))
    at = queries.columns.index("vector")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.filter(batch.column(at).is_valid())
            if not known.num_rows:
                continue
            asked = known.column(at).flatten().to_numpy(zero_copy_only=False).reshape(known.num_rows, -1)
            order = np.argsort(-(asked @ shared.value.T), axis=1, kind="stable")[:, :nprobe]
            rows = known.take(pa.array(np.repeat(np.arange(known.num_rows), order.shape[1])))
            yield rows.append_column("centroid", pa.array(numbers[order.ravel()], pa.int32()))

    return queries.mapInArrow(probe, StructType([*queries.schema.fields, StructField("centroid", IntegerType())]))


def recall_at_k(approximate: DataFrame, exact: DataFrame, query_id: str = "query_id", doc_id: str = "id") -> DataFrame:
    """One row: share of the exact hits that the approximate search found."""
    found = exact.join(approximate.select(query_id, doc_id).withColumn("_hit", F.lit(1)), [query_id, doc_id], "left")
    return found.agg((F.count("_hit") / F.count(F.lit(1))).alias("recall"))


# fixed values: keyword context weights
TITLE_POINTS, GENRE_POINTS, DIRECTOR_POINTS, WORD_POINTS = 3.0, 2.0, 2.0, 0.5
MIN_WORD = 4
# what str.split takes as white space, as a pattern
PYTHON_SPACE = r"[\s\x0B\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]+"


#: Bytes of strings that one task looks for in a scan.
DICTIONARY_BYTES = 8 << 20


def _dictionaries(strings: DataFrame, first: int) -> tuple[list, int]:
    """Broadcasts of (string -> slot) that hold the distinct ``s`` in parts of about DICTIONARY_BYTES; the next free slot."""
    distinct = settle(strings.where("s is not null").distinct())
    size = distinct.agg(F.sum(F.octet_length("s") + 16).alias("n")).first()["n"] or 0
    n = max(1, -(-size // DICTIONARY_BYTES))
    out = []
    for part in range(n):
        chosen = distinct.where(F.pmod(F.xxhash64("s"), F.lit(n)) == part) if n > 1 else distinct
        found = sorted(chosen.toArrow()["s"].to_pylist())
        out.append(strings.sparkSession.sparkContext.broadcast({s: first + i for i, s in enumerate(found)}))
        first += len(found)
    return out, first


class _Finder:
    """Finds which strings of a dictionary a text holds, in one pass; the empty string is in every text."""

    def __init__(self, slots: dict[str, int]):
        self.slots, self.always = slots, [slots[""]] if "" in slots else []
        self.machine = ahocorasick.Automaton()
        for s, slot in slots.items():
            if s:
                self.machine.add_word(s, slot)
        if len(self.machine):
            self.machine.make_automaton()

    def held(self, text: str) -> set[int]:
        found = set(self.always)
        if len(self.machine):
            found.update(slot for _, slot in self.machine.iter(text))
        return found


def _scan_vectors(
    rows: DataFrame, vector: Callable[[dict, _Finder, _Finder], dict[int, float]], words: list, names: list
) -> DataFrame:
    """id, vector of every row: ``vector`` tells slot -> weight from the row and the two dictionaries of a pass.

    A text is scanned once per pass and stays in its task; one pass does unless a dictionary has several parts.
    """
    id_col, kind = rows.columns[0], rows.schema[0].dataType.simpleString()
    # points are halves and a dictionary has fewer than 2^31 strings: narrow numbers are exact
    tail = "dense:array<double>,slots:array<int>,weights:array<float>"

    def scan(word_part, name_part) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finders = [_Finder(part.value if part is not None else {}) for part in (word_part, name_part)]
            for b in batches:
                made = [sorted(vector(row, *finders).items()) for row in b.to_pylist()]
                arrays = [
                    pa.array([[] for _ in made], pa.list_(pa.float64())),
                    pa.array([[s for s, _ in m] for m in made], pa.list_(pa.int32())),
                    pa.array([[w for _, w in m] for m in made], pa.list_(pa.float32())),
                ]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.StructArray.from_arrays(arrays, ["dense", "slots", "weights"])], [id_col, "vector"])

        return run

    parts = [rows.mapInArrow(scan(w, n), f"`{id_col}` {kind}, vector struct<{tail}>") for w, n in zip_longest(words, names)]
    if len(parts) == 1:
        return parts[0]
    both = reduce(DataFrame.unionAll, parts).groupBy(id_col)
    fields = [F.flatten(F.collect_list(f"vector.{f}")).alias(f) for f in ("dense", "slots", "weights")]
    return both.agg(*fields).select(id_col, F.struct("dense", "slots", "weights").alias("vector"))


def _query_vector(row: dict, words: _Finder, names: _Finder) -> dict[int, float]:
    out: dict[int, float] = dict.fromkeys(names.held(row["query"]), 1.0)
    for w in row["query"].split():
        if len(w) >= MIN_WORD and w in words.slots:
            out[words.slots[w]] = out.get(words.slots[w], 0.0) + WORD_POINTS
    return out


def _item_vector(row: dict, words: _Finder, names: _Finder) -> dict[int, float]:
    out: dict[int, float] = dict.fromkeys(words.held(row["plot"]), 1.0)
    own = [(row["title"], TITLE_POINTS), (row["director"], DIRECTOR_POINTS), *((g, GENRE_POINTS) for g in row["genres"])]
    for name, points in own:
        if name in names.slots:
            out[names.slots[name]] = out.get(names.slots[name], 0.0) + points
    return out


def keyword_context_join(queries: DataFrame, items: DataFrame, k: int = 5) -> DataFrame:
    """query_id, id, score, rank: substring points of every query with every item, the k best above zero.

    Title in query 3, each genre in query 2, director in query 2, each query word of four or more letters
    that occurs in the plot 0.5. An inverted substring index: the distinct query words are looked for in
    the plots, the distinct titles, directors and genres in the queries, each text in one pass of an
    automaton. What leaves a task is the numbers of the strings found, so the points are a sparse inner
    product. The questions, of few numbers each, travel to the postings of the items, which stay where they are.
    """
    q = queries.select("query_id", F.lower(F.coalesce("query", F.lit(""))).alias("query"))
    d = items.select(
        "id",
        F.lower(F.coalesce("title", F.lit(""))).alias("title"),
        F.split(F.lower(F.coalesce("genre", F.lit(""))), r"\|").alias("genres"),
        F.lower(F.coalesce("director", F.lit(""))).alias("director"),
        F.lower(F.coalesce("plot", F.lit(""))).alias("plot"),
    )
    spoken = q.select(F.explode(F.split("query", PYTHON_SPACE)).alias("s")).where(F.length("s") >= MIN_WORD)
    named = d.select(F.explode(F.concat(F.array("title", "director"), "genres")).alias("s"))
    words, free = _dictionaries(spoken, 0)
    names, _ = _dictionaries(named, free)
    asked = written(_scan_vectors(q, _query_vector, words, names), "questions")
    found = written(_scan_vectors(spread(d, "id"), _item_vector, words, names), "postings")
    return topk_inner_product(asked, found, k, "query_id", "id", min_score=WORD_POINTS, route="queries")
