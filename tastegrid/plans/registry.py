"""Registered queries, each next to the ANSI SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``fn(spark, folder)`` under ``name``; ``sql`` is left out where SQL cannot express it."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            # the tables carry UTC wall-clock times; windows are cut in the session zone
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, folder)

        run.__module__, run.__doc__ = fn.__module__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


# Shared SQL for the data model of tastegrid.sources.tables.
RATINGS = """raw_ratings AS (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS item_id,
         CAST(ceil(l_quantity / 10) AS DOUBLE) AS rating, o_orderdate AS ts,
         l_orderkey AS o_key, l_linenumber AS line
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ratings AS (
  SELECT user_id, item_id, rating, ts, o_key, line FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts, o_key, line, rating) AS rn FROM raw_ratings)
  WHERE rn = 1)"""
ITEMS = """items AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS title, p_type || '|' || p_brand AS genre,
         lower(p_type) || ' ' || p_name || ' by ' || p_brand AS plot,
         CAST(1990 + p_size % 35 AS INTEGER) AS year, round(p_retailprice / 500, 2) AS rating,
         p_brand AS director, p_partkey AS position
  FROM part)"""
CORPUS = """corpus AS (
  SELECT d.doc_id AS id, regexp_extract(d.text, '^[A-Za-z]*') AS title, d.lang AS genre, d.text AS plot,
         CAST(1990 + d.doc_id % 35 AS INTEGER) AS year, coalesce(CAST(q.quality AS DOUBLE), 0.5) AS rating,
         d.source AS director
  FROM documents d LEFT JOIN labels q ON d.doc_id = q.doc_id)"""
CONTENT = """'Title: ' || title || ' | Genre: ' || genre || ' | Year: ' || year || ' | Director: ' || director
         || ' | Plot: ' || plot"""
QA = """qa AS (
  SELECT u.conv_id || ':' || u.turn AS query_id, u.conv_id, u.turn, u.text AS query, a.text AS response
  FROM conversations u JOIN conversations a ON u.conv_id = a.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""
LOG = """log AS (
  SELECT event_id, ts, user_id AS key, event_type AS endpoint,
         CASE WHEN event_type IN ('signup', 'purchase') THEN 'POST' ELSE 'GET' END AS method,
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
         value / 50 AS duration, CAST(ceil(value) AS BIGINT) AS tokens, value
  FROM events)"""
# greedy admission, one event of every key per step; the limits are 2 requests and 60 tokens a minute, 3 requests a day
ADMISSION = """ev AS (SELECT key, event_id, epoch_us(ts) AS tick, tokens, row_number() OVER (PARTITION BY key ORDER BY ts, event_id) AS rn FROM log),
passed AS (
  SELECT DISTINCT key, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS BIGINT) AS tick,
    CAST([] AS STRUCT(a BIGINT, t BIGINT)[]) AS held, '' AS reason FROM ev
  UNION ALL
  SELECT key, rn, event_id, tick, CASE WHEN reason = 'ok' THEN list_append(day, {'a': tick, 't': tokens}) ELSE day END AS held, reason FROM (
    SELECT *, CASE WHEN len(day) >= 3 THEN 'daily' WHEN len(recent) >= 2 THEN 'rpm'
      WHEN coalesce(list_sum(list_transform(recent, lambda x: x.t)), 0) + tokens > 60 THEN 'tokens' ELSE 'ok' END AS reason FROM (
      SELECT *, list_filter(day, lambda x: x.a >= tick - 60000000) AS recent FROM (
        SELECT e.key, e.rn, e.event_id, e.tick, e.tokens, list_filter(p.held, lambda x: x.a >= e.tick - 86400000000) AS day
        FROM passed p JOIN ev e ON e.key = p.key AND e.rn = p.rn + 1))))"""
