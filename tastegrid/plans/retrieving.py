"""Document search queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.functions.hashing import digest_vector
from tastegrid.functions.text import doc_content
from tastegrid.functions.vectors import cosine_similarity, l2_normalize, relevance_from_distance
from tastegrid.operators import cleaning, retrieval, tfidf
from tastegrid.plans.ratings import digest_sql
from tastegrid.plans.registry import CONTENT, CORPUS, query
from tastegrid.sources import tables
from tastegrid.sources.tables import table

UNIT = "list_transform({v}, lambda x: x / sqrt(list_dot_product({v}, {v})))"
_STOP = ", ".join(f"'{w}'" for w in tfidf.STOP_WORDS)


def vectors(spark: SparkSession, d: str) -> DataFrame:
    """embeddings as unit vectors: id, vector, label."""
    e = table(spark, d, "embeddings")
    return e.select(F.col("vec_id").alias("id"), l2_normalize(F.col("embedding")).alias("vector"), "label")


VECTORS = """unit AS (
  SELECT vec_id AS id, label, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS v
  FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings))"""


def label_queries(spark: SparkSession, d: str) -> DataFrame:
    """One query vector per label: the unit mean of its vectors (summed per position, partial sums first)."""
    parts = vectors(spark, d).select("label", F.posexplode("vector").alias("slot", "x"))
    means = parts.groupBy("label", "slot").agg(F.avg("x").alias("weight"))
    dense = tfidf.dense(means.withColumn("label", F.col("label").cast("long")), "label", "slot", 64)
    return dense.select(F.col("label").alias("query_id"), l2_normalize(F.col("vector")).alias("vector"))


LABEL_QUERIES = f"""{VECTORS}, means AS (
  SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM unit) GROUP BY label, i),
lq AS (SELECT CAST(label AS BIGINT) AS query_id, list_transform(m, lambda x: x / sqrt(list_dot_product(m, m))) AS q
  FROM (SELECT label, list(m ORDER BY i) AS m FROM means GROUP BY label))"""


def corpus(spark: SparkSession, d: str) -> DataFrame:
    """The corpus with its searchable text and the fallback embedding of it."""
    return tables.corpus(spark, d, lambda docs: retrieval.embed_text(tables.with_content(docs), "content", "digest_core"))


def queries(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.embed_text(tables.user_turns(spark, d), "query", "digest_core")


SEARCH = f"""{CORPUS}, docs AS (SELECT *, {digest_sql('c')} AS e FROM (SELECT *, {CONTENT} AS c FROM corpus)),
q AS (SELECT conv_id || ':' || turn AS query_id, text AS query, {digest_sql('text')} AS qe FROM conversations WHERE role = 'user'),
hits AS (SELECT query_id, query, id, round(list_cosine_similarity(qe, e), 6) AS score FROM q, docs)"""


def _ranked(k: int, where: str = "score >= 0.1") -> str:
    return f"""SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
  FROM hits WHERE {where} QUALIFY rank <= {k}"""


@query("load_documents_csv", f"WITH {CORPUS} SELECT id, title, {CONTENT} AS content FROM corpus")
def _(spark, d):
    return tables.with_content(tables.corpus(spark, d)).select("id", "title", "content")


@query("doc_content", f"WITH {CORPUS} SELECT id, md5({CONTENT}) AS content_md5 FROM corpus")
def _(spark, d):
    c = tables.corpus(spark, d)
    text = doc_content(F.col("title"), F.col("genre"), F.col("year"), F.col("director"), F.col("plot"))
    return c.select("id", F.md5(text).alias("content_md5"))


@query(
    "embed_md5",
    f"""WITH {CORPUS} SELECT id, CAST(i - 1 AS INTEGER) AS slot, round(x, 6) AS value FROM (
  SELECT id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM (
    SELECT id, {digest_sql('c', 384)} AS v FROM (SELECT id, {CONTENT} AS c FROM corpus)))""",
)
def _(spark, d):
    docs = tables.with_content(tables.corpus(spark, d))
    return docs.select("id", F.posexplode(digest_vector(F.col("content"))).alias("slot", "value")).withColumn(
        "value", F.round("value", 6)
    )


@query(
    "embed_text",
    f"""WITH toks AS (SELECT doc_id, unnest(list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}_]+'),
    lambda t: length(t) >= 2 AND NOT list_contains([{_STOP}], t))) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY ALL),
df AS (SELECT term, ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + count(*))) + 1.0 AS idf,
  CAST(CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % 384 AS INTEGER) AS bucket FROM tf GROUP BY term),
w AS (SELECT doc_id, bucket, sum(tf * idf) AS w FROM tf JOIN df USING (term) GROUP BY ALL)
SELECT doc_id, bucket, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""",
)
def _(spark, d):
    weights = tfidf.hashed_vectors(tables.texts(spark, d, "documents", "doc_id"), "text", "doc_id")
    return weights.withColumn("weight", F.round("weight", 6))


@query(
    "l2_normalize",
    f"""WITH {VECTORS} SELECT id, CAST(i - 1 AS INTEGER) AS slot, round(x, 6) AS value
FROM (SELECT id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM unit)""",
)
def _(spark, d):
    return vectors(spark, d).select("id", F.posexplode("vector").alias("slot", "value")).withColumn("value", F.round("value", 6))


@query(
    "cosine_similarity",
    f"""WITH {LABEL_QUERIES} SELECT id, round(list_cosine_similarity(v, q), 6) AS similarity
FROM unit JOIN lq ON query_id = label""",
)
def _(spark, d):
    own = label_queries(spark, d).select(F.col("query_id").alias("label"), F.col("vector").alias("mean"))
    joined = vectors(spark, d).join(own, "label")
    return joined.select("id", F.round(cosine_similarity(F.col("vector"), F.col("mean")), 6).alias("similarity"))


@query(
    "relevance_from_distance",
    """SELECT event_id, round(CASE WHEN value / 100 <= 2 THEN 1 - value / 200 ELSE greatest(0, 1 / (1 + value / 100)) END, 6) AS score
FROM events""",
)
def _(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", F.round(relevance_from_distance(F.col("value") / 100), 6).alias("score"))


@query(
    "vector_topk",
    f"""WITH {LABEL_QUERIES}, hits AS (
  SELECT query_id, id, round(list_dot_product(q, v), 6) AS score FROM lq, unit)
SELECT query_id, id, score, CAST(rank AS INTEGER) AS rank FROM ({_ranked(10)})""",
)
def _(spark, d):
    return retrieval.vector_topk(label_queries(spark, d), vectors(spark, d), 10, digits=6)


@query(
    "vector_topk_filtered",
    f"""WITH {SEARCH}, pool AS (SELECT id FROM corpus WHERE genre LIKE '%e%' AND year >= 2000 AND rating >= 0.5)
SELECT query_id, id, score, CAST(rank AS INTEGER) AS rank FROM ({_ranked(5, 'score >= 0.1 AND id IN (SELECT id FROM pool)')})""",
)
def _(spark, d):
    filters = {"genre": "E", "year_min": 2000, "rating_min": 0.5, "language": "ignored"}
    return retrieval.vector_topk(queries(spark, d), corpus(spark, d), 5, filters, digits=6)


@query(
    "vector_topk_overfetch",
    f"""WITH {SEARCH}, first AS ({_ranked(15)})
SELECT query_id, id, score, CAST(rn AS INTEGER) AS rank FROM (
  SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY f.rank) AS rn FROM first f
  WHERE id IN (SELECT id FROM corpus WHERE year >= 2000)) WHERE rn <= 5""",
)
def _(spark, d):
    return retrieval.vector_topk(
        queries(spark, d), corpus(spark, d), 5, {"year_min": 2000}, overfetch=retrieval.OVERFETCH, digits=6
    )


@query(
    "score_threshold",
    f"""WITH {SEARCH} SELECT query_id, id, score FROM ({_ranked(10, 'score >= -1')}) WHERE score >= 0.75""",
)
def _(spark, d):
    hits = retrieval.vector_topk(queries(spark, d), corpus(spark, d), 10, min_score=None, digits=6)
    return cleaning.score_threshold(hits, 0.75).drop("rank")


@query(
    "context_for_query",
    f"""WITH {SEARCH} SELECT query_id, h.id, CAST(rank AS INTEGER) AS rank, score AS relevance_score, c.title, c.genre, c.year,
  c.rating, c.director, md5(c.plot) AS plot_md5 FROM ({_ranked(5)}) h JOIN corpus c ON h.id = c.id""",
)
def _(spark, d):
    found = retrieval.context_for_query(queries(spark, d), corpus(spark, d), 5, digits=6)
    return found.withColumn("plot_md5", F.md5("plot")).drop("plot")


@query(
    "context_cap",
    f"""WITH {SEARCH} SELECT query_id, id, score FROM ({_ranked(8)})
WHERE rank <= least(1 + CAST(split_part(query_id, ':', 2) AS INTEGER), 5)""",
)
def _(spark, d):
    # each query asks for 1 + its turn number documents; five is the most that is used
    hits = retrieval.vector_topk(queries(spark, d), corpus(spark, d), 8, digits=6)
    asked = F.split_part("query_id", F.lit(":"), F.lit(2)).cast("int") + 1
    return hits.where(F.col("rank") <= cleaning.context_cap(asked)).drop("rank")


@query(
    "search_results",
    f"""WITH {SEARCH} SELECT query_id, h.id, title, genre, year, rating, director, score AS relevance_score,
  CAST(rank AS INTEGER) AS rank, CAST(count(*) OVER (PARTITION BY query_id) AS BIGINT) AS total
FROM ({_ranked(10, "score >= 0.1 AND id IN (SELECT id FROM corpus WHERE genre LIKE '%en%' AND year <= 2010)")}) h
JOIN corpus c ON h.id = c.id""",
)
def _(spark, d):
    filters = cleaning.search_filters(genre="EN", year_min=0, year_max=2010)
    return retrieval.search_results(queries(spark, d), corpus(spark, d), 10, filters, digits=6)


@query(
    "similar_items",
    f"""WITH {VECTORS}, hits AS (
  SELECT a.id AS query_id, b.id AS id, round(list_dot_product(a.v, b.v), 6) AS score FROM unit a, unit b WHERE a.id <> b.id)
SELECT query_id AS id, id AS similar_id, score, CAST(rank AS INTEGER) AS rank FROM ({_ranked(5, 'true')})""",
)
def _(spark, d):
    return retrieval.similar_items(vectors(spark, d), 5, digits=6)


@query(
    "hybrid_search",
    f"""WITH {SEARCH.replace('6) AS score FROM q', '9) AS score FROM q')}, pool AS ({_ranked(10)}), scored AS (
  SELECT query_id, p.id, 0.7 * score + 0.3 * len(list_filter(terms, lambda t: contains(text, t)))
    / greatest(len(terms), 1) AS score
  FROM (SELECT *, list_distinct(list_filter(string_split_regex(lower(query), '\\s+'), lambda w: w <> '')) AS terms FROM pool) p
  JOIN (SELECT id, lower(title || ' ' || genre || ' ' || director || ' ' || plot) AS text FROM corpus) c ON p.id = c.id)
SELECT query_id, id, round(round(score, 9), 6) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank FROM scored) WHERE rank <= 5""",
)
def _(spark, d):
    found = retrieval.hybrid_search(queries(spark, d), corpus(spark, d), 5)
    return found.withColumn("score", F.round("score", 6))


@query(
    "hybrid_rerank",
    f"""WITH {LABEL_QUERIES}, hits AS (SELECT query_id, id, label, round(list_dot_product(q, v), 6) AS score FROM lq, unit),
pool AS ({_ranked(20, 'true')})
SELECT query_id, id, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT query_id, id, round(0.7 * score + 0.3 * CASE WHEN contains('label ' || label, CAST(query_id AS VARCHAR)) THEN 1 ELSE 0 END, 6) AS score,
    row_number() OVER (PARTITION BY query_id ORDER BY
      round(0.7 * score + 0.3 * CASE WHEN contains('label ' || label, CAST(query_id AS VARCHAR)) THEN 1 ELSE 0 END, 6) DESC, id) AS rank
  FROM pool) WHERE rank <= 10""",
)
def _(spark, d):
    v = vectors(spark, d)
    pool = retrieval.vector_topk(label_queries(spark, d), v, 20, min_score=None, digits=6).drop("rank")
    text = v.select("id", F.concat(F.lit("label "), F.col("label").cast("string")).alias("_text"))
    candidates = pool.join(text, "id").withColumn("query", F.col("query_id").cast("string"))
    return retrieval.hybrid_rerank(candidates, 10, digits=6)


#: Cells of the registered index; a parameter of the index, not of the table's size.
CELLS = 32


@query(
    "ivf_build",
    f"""WITH {VECTORS} SELECT id, label, round(v[1], 6) AS first, true AS nearest FROM unit""",
)
def _(spark, d):
    """Every vector once, with its unit form, and whether its cell is the one with the nearest centre."""
    indexed, centers = retrieval.ivf_build(vectors(spark, d), cells=CELLS)
    rows = indexed.select("id", "label", "vector", F.col("centroid").alias("own"))
    # every vector meets every centre: CELLS of them
    centre = F.broadcast(centers.select(F.col("centroid").alias("cell"), F.col("vector").alias("centre")))
    gap = F.aggregate(F.zip_with("vector", "centre", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    met = rows.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(CELLS - 1)))).join(centre, "cell").withColumn("gap", gap)
    own = F.min(F.when(F.col("cell") == F.col("own"), F.col("gap")))
    checked = met.groupBy("id", "label", F.round(F.col("vector")[0], 6).alias("first")).agg((own <= F.min("gap") + 1e-9).alias("nearest"))
    return checked.select("id", "label", "first", "nearest")


@query(
    "ivf_search_all_cells",
    f"""WITH {LABEL_QUERIES}, hits AS (SELECT query_id, id, round(list_dot_product(q, v), 6) AS score FROM lq, unit)
SELECT query_id, id, score, CAST(rank AS INTEGER) AS rank FROM ({_ranked(10, 'true')})""",
)
def _(spark, d):
    """A search that probes all cells gives the exact hits."""
    indexed, centers = retrieval.ivf_build(vectors(spark, d), cells=CELLS)
    found = retrieval.ivf_search(label_queries(spark, d), indexed, centers, 10, nprobe=CELLS)
    return found.withColumn("score", F.round("score", 6))


@query("ivf_search")
def _(spark, d):
    """Cell search for the label means, with the recall against the exact search."""
    v = vectors(spark, d)
    asked = label_queries(spark, d)
    indexed, centers = retrieval.ivf_build(v, cells=CELLS)
    found = retrieval.ivf_search(asked, indexed, centers, 10, nprobe=2)
    return retrieval.recall_at_k(found, retrieval.vector_topk(asked, v, 10, min_score=None))


@query(
    "match_filters",
    f"""WITH {CORPUS} SELECT id, genre, year, rating, director FROM corpus
WHERE contains(lower(genre), 'e') AND contains(lower(director), 'src1') AND year >= 1995 AND year <= 2015 AND rating >= 0.5""",
)
def _(spark, d):
    filters = {"genre": "E", "director": "SRC1", "year_min": 1995, "year_max": 2015, "rating_min": 0.5, "other": 1}
    return cleaning.match_filters(tables.corpus(spark, d), filters).select("id", "genre", "year", "rating", "director")


@query(
    "fetch_by_id",
    f"WITH {CORPUS} SELECT id, title, genre FROM corpus WHERE id IN (SELECT doc_id FROM labels WHERE toxic = 1)",
)
def _(spark, d):
    wanted = table(spark, d, "labels").where("toxic = 1").select(F.col("doc_id").alias("id"))
    return cleaning.fetch_by_id(tables.corpus(spark, d), wanted).select("id", "title", "genre")


@query(
    "keyword_context_join",
    f"""WITH {CORPUS}, q AS (SELECT conv_id || ':' || turn AS query_id, lower(text) AS query FROM conversations WHERE role = 'user'),
d AS (SELECT id, lower(title) AS title, string_split(lower(genre), '|') AS genres, lower(director) AS director, lower(plot) AS plot FROM corpus),
qw AS (SELECT query_id, word, count(*) AS n FROM (SELECT query_id, unnest(string_split_regex(query, '\\s+')) AS word FROM q)
  WHERE length(word) > 3 GROUP BY ALL),
wd AS (SELECT word, id FROM (SELECT DISTINCT word FROM qw) w JOIN d ON contains(d.plot, w.word)),
pts AS (SELECT query_id, id, 0.5 * sum(n) AS p FROM qw JOIN wd USING (word) GROUP BY ALL),
hits AS (SELECT q.query_id, d.id, CAST(coalesce(p, 0) + CASE WHEN contains(query, title) THEN 3 ELSE 0 END
    + CASE WHEN contains(query, director) THEN 2 ELSE 0 END + 2 * len(list_filter(genres, lambda g: contains(query, g))) AS DOUBLE) AS score
  FROM q CROSS JOIN d LEFT JOIN pts ON q.query_id = pts.query_id AND d.id = pts.id)
SELECT query_id, id, score, CAST(rank AS INTEGER) AS rank FROM ({_ranked(5, 'score > 0')})""",
)
def _(spark, d):
    return retrieval.keyword_context_join(tables.user_turns(spark, d), tables.corpus(spark, d))


@query(
    "drift_feature_select",
    f"WITH {CORPUS} SELECT genre, year, rating, director, id, title FROM corpus",
)
def _(spark, d):
    return cleaning.drift_feature_select(tables.corpus(spark, d))


@query(
    "keyword_share",
    f"""WITH {SEARCH}, pool AS ({_ranked(3)})
SELECT query_id, p.id, round(len(list_filter(terms, lambda t: contains(text, t))) / greatest(len(terms), 1), 6) AS share
FROM (SELECT *, list_distinct(list_filter(string_split_regex(lower(query), '\\s+'), lambda w: w <> '')) AS terms FROM pool) p
JOIN (SELECT id, lower(plot) AS text FROM corpus) c ON p.id = c.id""",
)
def _(spark, d):
    from tastegrid.functions.text import keyword_score

    docs = corpus(spark, d)
    asked = queries(spark, d)
    pool = retrieval.vector_topk(asked, docs, 3, digits=6).join(asked.select("query_id", "query"), "query_id")
    joined = pool.join(docs.select("id", F.lower("plot").alias("text")), "id")
    return joined.select("query_id", "id", F.round(keyword_score(F.col("query"), F.col("text")), 6).alias("share"))
