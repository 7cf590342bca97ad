"""Source, sink and streaming queries: every one writes the test tables out and reads them back."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid import schemas
from tastegrid.functions import guards
from tastegrid.functions.hashing import cache_key
from tastegrid.functions.vectors import l2_normalize
from tastegrid.operators import drift, evaluating, factors, retrieval, telemetry
from tastegrid.operators.prompting import build_prompts, register_strategy
from tastegrid.operators.cleaning import clean_ratings
from tastegrid.operators.recommending import matrix_shape
from tastegrid.plans import experimenting, monitoring  # noqa: F401  their SQL is read below
from tastegrid.plans.guarding import _INPUT_VIOLATIONS, SCREENED
from tastegrid.plans.ratings import ORDER
from tastegrid.plans.registry import ADMISSION, CONTENT, CORPUS, ITEMS, LOG, ORACLE, QA, RATINGS, query
from tastegrid.session import written
from tastegrid.sources import readers, stores, tables
from tastegrid.streaming import jobs

BOUNDS = telemetry.BUCKETS["http_request_duration"]
NTZ = "timestamp_ntz"


def _csv(df: DataFrame, name: str) -> str:
    path = stores.scratch_folder(df.sparkSession, name)
    df.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return path


def _items_csv(spark: SparkSession, d: str) -> str:
    return _csv(tables.items(spark, d).drop("position"), "items")


@query("read_items", f"WITH {ITEMS} SELECT id, title, genre, plot, year, rating, director FROM items")
def _(spark, d):
    # the primary place does not exist: the fallback is read
    found = readers.read_items(spark, stores.scratch_folder(spark, "absent"), _items_csv(spark, d))
    return found.select("id", "title", "genre", "plot", "year", "rating", "director")


@query("read_ratings", f"WITH {RATINGS} SELECT user_id, item_id AS movie_id, rating FROM ratings")
def _(spark, d):
    rated = clean_ratings(tables.raw_ratings(spark, d), ORDER)
    path = _csv(rated.select(F.col("item_id").alias("movie_id"), "rating", "user_id"), "ratings")
    return readers.read_ratings(spark, path).drop("timestamp")


@query("load_csv", "SELECT CAST(o_orderkey AS VARCHAR) AS user_id, CAST(o_custkey AS VARCHAR) AS movie_id, o_totalprice AS rating FROM orders")
def _(spark, d):
    o = tables.table(spark, d, "orders")
    path = _csv(o.select(F.col("o_orderkey").alias("user_id"), F.col("o_custkey").alias("movie_id"), F.col("o_totalprice").alias("rating")), "orders")
    return readers.load_csv(spark, path, schemas.RATINGS).drop("timestamp")


@query("load_items_as_documents", f"WITH {ITEMS} SELECT id, {CONTENT} AS content FROM items")
def _(spark, d):
    return readers.load_documents_csv(spark, _items_csv(spark, d)).select("id", "content")


@query(
    "load_documents_json",
    f"""WITH {CORPUS} SELECT CAST(id AS VARCHAR) AS id, title, CASE WHEN year > 2000 THEN year ELSE 0 END AS year, rating, md5(plot) AS plot_md5,
  '' AS "cast" FROM corpus""",
)
def _(spark, d):
    path = stores.scratch_folder(spark, "documents")
    c = tables.corpus(spark, d).withColumn("year", F.when(F.col("year") > 2000, F.col("year")))
    c.write.json(path)
    docs = readers.load_documents_json(spark, path, lines=True)
    return docs.select("id", "title", "year", "rating", F.md5("plot").alias("plot_md5"), "cast")


@query(
    "read_eval_jsonl",
    "SELECT CAST(item_id AS VARCHAR) AS id, text AS query, lower(text) AS reference, 'information' AS category FROM benchmark",
)
def _(spark, d):
    path = stores.scratch_folder(spark, "eval")
    b = tables.table(spark, d, "benchmark")
    b.select(
        F.col("item_id").cast("string").alias("id"),
        F.col("text").alias("query"),
        F.lower("text").alias("reference"),
        F.lit("information").alias("category"),
    ).write.json(path)
    return readers.read_eval_jsonl(spark, path)


@query("ingest", f"WITH {ITEMS} SELECT id, title, {CONTENT} AS content, CAST(384 AS INTEGER) AS dims, (SELECT count(*) FROM items) AS n_documents FROM items")
def _(spark, d):
    path = stores.scratch_folder(spark, "index")
    n = stores.ingest(spark, _items_csv(spark, d), "csv", path)
    stored, _ = stores.load_index(spark, path)
    return stored.select("id", "title", "content", F.size("vector").alias("dims"), F.lit(n).cast("long").alias("n_documents"))


def stored_index(spark: SparkSession, d: str) -> DataFrame:
    path = stores.scratch_folder(spark, "index")
    docs = retrieval.embed_text(tables.with_content(tables.corpus(spark, d)), "content")
    stores.save_index(*retrieval.ivf_build(docs, cells=16), path)
    return stores.load_index(spark, path)[0]


@query(
    "save_index",
    f"""WITH {CORPUS} SELECT genre, CAST(count(*) AS BIGINT) AS n, CAST(sum(id) AS BIGINT) AS ids, min(md5(content)) AS least, max(md5(content)) AS most
FROM (SELECT id, genre, {CONTENT} AS content FROM corpus) GROUP BY genre""",
)
def _(spark, d):
    """Two versions are stored in turn; the second one is in force."""
    path = stores.scratch_folder(spark, "index")
    docs = retrieval.embed_text(tables.with_content(tables.corpus(spark, d)), "content")
    stores.save_index(*retrieval.ivf_build(docs.where("genre = 'en'"), cells=4), path)
    stores.save_index(*retrieval.ivf_build(docs, cells=16), path)
    stored = stores.load_index(spark, path)[0]
    return stored.groupBy("genre").agg(
        F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"), F.min(F.md5("content")).alias("least"), F.max(F.md5("content")).alias("most")
    )


@query("load_index", f"WITH {CORPUS} SELECT id, title, CAST(384 AS INTEGER) AS dims, md5({CONTENT}) AS content_md5 FROM corpus")
def _(spark, d):
    return stored_index(spark, d).select("id", "title", F.size("vector").alias("dims"), F.md5("content").alias("content_md5"))


@query("ensure_index", f"WITH {ITEMS} SELECT id, title FROM items")
def _(spark, d):
    stored, _ = stores.ensure_index(spark, stores.scratch_folder(spark, "index"), _items_csv(spark, d))
    return stored.select("id", "title")


def stored_model(spark: SparkSession, d: str) -> tuple[factors.Factors, dict]:
    path = stores.scratch_folder(spark, "model")
    rated = written(clean_ratings(tables.raw_ratings(spark, d), ORDER).select("user_id", "item_id", "rating"), "ratings")
    model = factors.fit_svd(rated)
    shape = matrix_shape(rated).first()
    stores.save_model(model, path, "v1", n_components=len(model.singular_values), n_users=shape["n_users"], n_items=shape["n_items"])
    # the first place is empty, the second holds the model
    return stores.load_model(spark, [f"{path}-absent", path], required=True)


@query(
    "save_model",
    f"""WITH {RATINGS} SELECT 'v1' AS version, CAST(least(50, least(count(DISTINCT user_id), count(DISTINCT item_id)) - 1) AS INTEGER) AS n_values,
  CAST(count(DISTINCT user_id) AS VARCHAR) AS n_users, CAST(count(DISTINCT item_id) AS VARCHAR) AS n_items,
  CAST(count(DISTINCT user_id) AS BIGINT) AS user_rows, CAST(count(DISTINCT item_id) AS BIGINT) AS item_rows FROM ratings""",
)
def _(spark, d):
    model, meta = stored_model(spark, d)
    row = [(meta["version"], len(model.singular_values), meta["n_users"], meta["n_items"], model.user_factors.count(), model.item_factors.count())]
    return spark.createDataFrame(row, "version string, n_values int, n_users string, n_items string, user_rows long, item_rows long")


@query(
    "load_model",
    "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS user_id, CAST(50 AS INTEGER) AS dims FROM orders JOIN lineitem ON l_orderkey = o_orderkey",
)
def _(spark, d):
    return stored_model(spark, d)[0].user_factors.select("user_id", F.size("vector").alias("dims"))


@query("write_experiment_results", ORACLE["summarize_strategies"])
def _(spark, d):
    path = stores.scratch_folder(spark, "results")
    summary = evaluating.summarize_strategies(experimenting.scored(spark, d)).persist()
    n = summary.agg(F.max("num_samples")).first()[0]
    stores.write_experiment_results(summary, evaluating.compare_strategies(summary), n, path)
    summary.unpersist()
    means = ["rouge_l_f1", "embedding_similarity", "factuality", "helpfulness", "latency_ms", "error_rate"]
    stored = spark.read.json(f"{path}/summaries").select("strategy", "num_samples", "tokens", *means)
    return stored.withColumns({c: F.round(c, 6) for c in means})


@query("write_drift_report", ORACLE["corpus_drift"])
def _(spark, d):
    path = stores.scratch_folder(spark, "drift")
    c = tables.corpus(spark, d)
    rows = drift.corpus_drift(c.where("genre <> 'de'"), c.where("genre <> 'fr'"))
    stores.write_drift_report(rows, drift.dataset_drift(rows), path)
    stored = spark.read.json(f"{path}/columns")
    return stored.select("column_name", "method", F.round("score", 6).alias("score"), "drifted")


@query(
    "append_metric",
    "SELECT event_type AS name, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type",
)
def _(spark, d):
    path = stores.scratch_folder(spark, "metrics")
    e = tables.table(spark, d, "events")
    rows = e.select(
        F.col("event_type").alias("name"), "value", F.lit("Count").alias("unit"),
        F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("dimensions"), tables.instant("ts").alias("ts"),
    )
    stores.append_metric(rows.where("name <> 'error'"), path)
    stores.append_metric(rows.where("name = 'error'"), path)
    return spark.read.parquet(path).groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("append_log", "SELECT 'requests' AS log_group, event_type AS log_stream, props AS message, ts FROM events")
def _(spark, d):
    path = stores.scratch_folder(spark, "log")
    e = tables.table(spark, d, "events")
    stores.append_log(
        e.select(F.lit("requests").alias("log_group"), F.col("event_type").alias("log_stream"), F.col("props").alias("message"), tables.instant("ts").alias("ts")),
        path,
    )
    return spark.read.parquet(path).select("log_group", "log_stream", "message", F.col("ts").cast(NTZ).alias("ts"))


@query(
    "register_strategy",
    "SELECT conv_id || ':' || turn AS query_id, 'plain' AS strategy, 'Q: ' || text AS prompt FROM conversations WHERE role = 'user'",
)
def _(spark, d):
    """A strategy added by the caller."""
    register_strategy("plain", lambda q, c: F.concat(F.lit("Q: "), q))
    asked = tables.user_turns(spark, d).withColumn("context", F.array())
    return build_prompts(asked, ["plain"]).select("query_id", "strategy", "prompt")


@query(
    "embedding_model",
    f"""WITH {CORPUS} SELECT id, round(length(plot) / sqrt(length(plot) * length(plot) + 1.0), 6) AS first FROM corpus""",
)
def _(spark, d):
    """A model added by the caller as an Arrow-batched UDF; it is set up once per Python worker."""
    def lengths(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scale = 1.0  # the place to load weights
        for text in batches:
            yield pd.Series([[scale * len(t), 1.0] for t in text])

    lengths = F.pandas_udf(lengths, "array<double>")
    retrieval.register_embedding_model("length", lambda c: l2_normalize(lengths(c)))
    embedded = retrieval.embed_text(tables.corpus(spark, d), "plot", "length")
    return embedded.select("id", F.round(F.col("vector")[0], 6).alias("first"))


@query(
    "toxicity_model",
    """WITH s AS (SELECT doc_id, length(replace(lower(text), 'e', '')) / greatest(length(text), 1.0) AS v FROM documents)
SELECT doc_id, 'toxicity' AS max_category, round(1 - v, 6) AS max_score, round(1 - v, 6) < 0.1::DOUBLE AS passed FROM s""",
)
def _(spark, d):
    """A classifier added by the caller: an iterator UDF gives the score, the threshold rule stays here."""

    def share_of_e(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for text in batches:
            yield pd.Series([t.lower().count("e") / max(len(t), 1) for t in text])

    score = F.pandas_udf(share_of_e, "double")
    docs = tables.table(spark, d, "documents").select("doc_id", score("text").alias("s"))
    r = guards.toxicity_scores(F.create_map(F.lit("toxicity"), F.round("s", 6)), threshold=0.1)
    rows = docs.select("doc_id", r.alias("r")).select("doc_id", "r.max_category", "r.max_score", "r.passed")
    return rows.withColumn("max_score", F.round("max_score", 6))


@query(
    "context_provider",
    f"""WITH {CORPUS}, {QA} SELECT query_id, 'zero_shot' AS strategy, CAST(count(*) AS BIGINT) AS n_prompts
FROM qa JOIN corpus ON id = conv_id GROUP BY query_id""",
)
def _(spark, d):
    """Context chosen by a function of the caller: the document with the number of the conversation."""
    docs = tables.corpus(spark, d).withColumn("cast", F.lit(""))

    def provider(questions: DataFrame) -> DataFrame:
        keyed = questions.withColumn("id", F.split_part("query_id", F.lit(":"), F.lit(1)).cast("long"))
        fields = F.struct("title", "genre", "year", "rating", "director", "cast", "plot")
        return keyed.join(docs, "id").select("query_id", F.array(fields).alias("context"))

    asked = provider(tables.qa_pairs(spark, d).select("query_id", "query"))
    prompts = build_prompts(asked.withColumn("query", F.lit("?")), ["zero_shot"])
    return prompts.groupBy("query_id", "strategy").agg(F.count("prompt").alias("n_prompts"))


# ---- streams ----
def log_stream(spark: SparkSession, d: str) -> DataFrame:
    e = jobs.read_table_stream(spark, f"{d}/events.parquet")
    kind = F.col("event_type")
    return e.select(
        "event_id", tables.instant("ts").alias("ts"), kind.alias("key"), kind.alias("endpoint"), "user_id",
        (F.col("value") / 50).alias("duration"), F.ceil("value").cast("long").alias("tokens"), "props",
    )


CLOSED = "<= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"


@query(
    "stream_usage_windows",
    f"""WITH {LOG}, w AS (SELECT date_trunc('hour', ts) AS window_start, endpoint AS key, CAST(count(*) AS BIGINT) AS requests,
  CAST(sum(tokens) AS BIGINT) AS tokens FROM log GROUP BY ALL)
SELECT * FROM w WHERE window_start + INTERVAL 1 HOUR {CLOSED}""",
)
def _(spark, d):
    """Closed windows of the stream."""
    rows = jobs.run_available(jobs.stream_usage_windows(log_stream(spark, d), "1 hour"), stores.scratch_folder(spark, "usage"))
    return rows.withColumn("window_start", F.col("window_start").cast(NTZ))


@query(
    "stream_metrics",
    f"""WITH {LOG}, h AS (SELECT date_trunc('day', ts) AS window_start, endpoint, le, b, CAST(count(*) FILTER (duration <= b) AS BIGINT) AS n
  FROM log, (VALUES {", ".join(f"('{float(b)}', {b}::DOUBLE)" for b in BOUNDS)}, ('+Inf', 'Infinity'::DOUBLE)) t(le, b) GROUP BY ALL)
SELECT window_start, endpoint, le, n FROM h WHERE window_start + INTERVAL 1 DAY {CLOSED}""",
)
def _(spark, d):
    rows = jobs.run_available(
        jobs.stream_metrics(log_stream(spark, d), "duration", BOUNDS, "1 day"), stores.scratch_folder(spark, "metrics")
    )
    return rows.withColumn("window_start", F.col("window_start").cast(NTZ))


@query(
    "stream_guardrails",
    f"""WITH {SCREENED}, v AS ({_INPUT_VIOLATIONS}), arrived AS (SELECT doc_id, TIMESTAMP '2024-01-01' + INTERVAL 1 MINUTE * doc_id AS ts FROM screened),
w AS (SELECT date_trunc('hour', ts) AS window_start, guardrail_type, severity, CAST(count(*) AS BIGINT) AS n FROM v JOIN arrived USING (doc_id) GROUP BY ALL)
SELECT * FROM w WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM arrived)""",
)
def _(spark, d):
    """documents arrive one per minute, each checked on the way in."""
    docs = jobs.read_table_stream(spark, f"{d}/documents.parquet")
    leads = F.array(*[F.lit(x) for x in tables.LEADS])
    lead = F.get(leads, (F.col("doc_id") % len(tables.LEADS)).cast("int"))
    ts = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("doc_id") * 60)
    texts = docs.select(ts.alias("ts"), F.concat(lead, F.lit("\n"), F.col("text")).alias("text"))
    rows = jobs.run_available(jobs.stream_guardrails(texts), stores.scratch_folder(spark, "guardrails"))
    return rows.withColumn("window_start", F.col("window_start").cast(NTZ))


@query("dedup_prompts", "SELECT CAST(count(DISTINCT (props, event_type)) AS BIGINT) AS n FROM events")
def _(spark, d):
    """Distinct prompts of one backlog: all of it is within one time to live of its first micro-batch."""
    key = cache_key(prompt=F.col("props"), system=F.col("key"))
    requests = log_stream(spark, d).select("ts", key.alias("cache_key"))
    rows = jobs.run_available(jobs.dedup_prompts(requests, "60 days"), stores.scratch_folder(spark, "dedup"))
    return rows.agg(F.count(F.lit(1)).alias("n"))


@query("stream_admission", f"WITH RECURSIVE {LOG}, {ADMISSION} SELECT key, event_id, reason, reason = 'ok' AS admitted FROM passed WHERE rn > 0")
def _(spark, d):
    """Streamed admission per user, all events decided: an end mark after the last event moves the watermark past it.

    The mark itself waits behind the watermark, so it never gets a decision.
    """
    log = log_stream(spark, d).withColumn("key", F.col("user_id")).select("key", "event_id", "ts", "tokens")
    last = tables.table(spark, d, "events").agg(F.max(tables.instant("ts")).alias("ts"))
    mark = last.select(
        F.lit(None).cast(log.schema["key"].dataType).alias("key"), F.lit(-1).cast(log.schema["event_id"].dataType).alias("event_id"),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("ts"), F.lit(0).cast("long").alias("tokens"),
    )
    folder = stores.scratch_folder(spark, "admission")
    mark.write.parquet(f"{folder}-end")
    log = log.unionByName(spark.readStream.schema(log.schema).parquet(f"{folder}-end"))
    rows = jobs.run_available(jobs.stream_admission(log, 2, 60, 3), folder)
    return rows.select("key", "event_id", "reason", "admitted")
