"""Prompt, evaluation, cache, A/B and text-function queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.functions import hashing, scoring, text
from tastegrid.operators import abtest, caching, cleaning, evaluating, prompting
from tastegrid.operators.prompting import NUMBER, TEMPLATES, Part, as_shown
from tastegrid.plans.guarding import ANSWERED, lit
from tastegrid.plans.registry import CORPUS, ITEMS, QA, query
from tastegrid.schemas import EXTRACTED_ITEM
from tastegrid.sources import tables
from tastegrid.sources.tables import instant, table

WORDS = "list_filter(string_split_regex({c}, '\\s+'), lambda w: w <> '')"


def words_sql(c: str) -> str:
    return WORDS.format(c=c)


def sql_text(value: str) -> str:
    """A SQL string literal; line breaks are spelled out."""
    return " || chr(10) || ".join(lit(p) for p in value.split("\n"))


def template_sql(template) -> str:
    """The prompt of one template over ctx (documents of a query) and answered (queries)."""
    shown = []
    for p in template.block:
        if p is NUMBER:
            shown.append("CAST(pos AS VARCHAR)")
        elif isinstance(p, Part):
            column = "''" if p.field == "cast" else f"CAST(c.{p.field} AS VARCHAR)"
            value = f"coalesce({column}, {lit(p.default)})"
            shown.append(value if p.width is None else f"substr({value}, 1, {p.width})")
        else:
            shown.append(sql_text(p))
    block = " || ".join(shown)
    return f"""SELECT a.query_id, {lit(template.name)} AS strategy, {sql_text(template.head)}
  || coalesce((SELECT {sql_text(template.context_head)} || string_agg({block}, '' ORDER BY pos) || {sql_text(template.context_tail)}
     FROM ctx c WHERE c.query_id = a.query_id), '')
  || {sql_text(template.before)} || a.query || {sql_text(template.after)} AS prompt FROM answered a"""


_PROMPTS = " UNION ALL ".join(template_sql(t) for t in TEMPLATES)


@query("build_prompts", f"WITH {ANSWERED} SELECT query_id, strategy, md5(prompt) AS prompt_md5 FROM ({_PROMPTS})")
def _(spark, d):
    prompts = prompting.build_prompts(tables.answered(spark, d))
    return prompts.select("query_id", "strategy", F.md5("prompt").alias("prompt_md5"))


@query(
    "select_strategies",
    f"WITH {ANSWERED} SELECT strategy, CAST(count(*) AS BIGINT) AS n, CAST(sum(length(prompt)) AS BIGINT) AS chars FROM ({_PROMPTS}) "
    "WHERE strategy IN ('zero_shot', 'meta_prompt') GROUP BY strategy",
)
def _(spark, d):
    prompts = prompting.build_prompts(tables.answered(spark, d), ["zero_shot", "meta_prompt"])
    return prompts.groupBy("strategy").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("prompt")).alias("chars"))


@query(
    "default_prompt",
    f"""WITH {ANSWERED} SELECT a.query_id, md5('Answer the question from the items listed below.' || chr(10) || chr(10)
  || coalesce((SELECT string_agg('- ' || title || ' (' || year || '): ' || substr(plot, 1, 200), chr(10) ORDER BY pos)
     FROM ctx c WHERE c.query_id = a.query_id), '')
  || chr(10) || chr(10) || 'Question: ' || query || chr(10) || chr(10) || 'Be brief and cite items from the list.') AS prompt_md5
FROM answered a""",
)
def _(spark, d):
    prompt = text.default_prompt(F.col("query"), F.col("context"))
    return tables.answered(spark, d).select("query_id", F.md5(prompt).alias("prompt_md5"))


@query(
    "task_prompts",
    f"""WITH {ITEMS} SELECT id,
  md5('Write a casual blurb of at most 100 characters.' || chr(10) || chr(10) || 'Title: ' || title || chr(10) || 'Genre: ' || genre
    || chr(10) || 'Year: ' || year || chr(10) || 'Plot: ' || substr(plot, 1, 300) || chr(10) || chr(10) || 'Only the blurb.') AS blurb_md5,
  md5('One sentence, at most 100 characters: why this item?' || chr(10) || chr(10) || 'Item: ' || title || ' (' || year || ')' || chr(10)
    || 'Genre: ' || genre || chr(10) || 'Director: ' || director || chr(10) || 'User enjoys: ' || genre) AS rationale_md5,
  md5('Extract film data from the text as one JSON object; null where absent.' || chr(10) || chr(10) || 'Text: ' || plot || chr(10)
    || chr(10) || 'Fields: title, year, director, genres, cast, runtime_minutes') AS extract_md5 FROM items""",
)
def _(spark, d):
    items = tables.items(spark, d)
    doc = F.struct("title", "genre", "year", "director", "plot")
    return items.withColumn("doc", doc).select(
        "id",
        F.md5(prompting.blurb_prompt(F.col("doc"), F.lit("casual"), F.lit(100))).alias("blurb_md5"),
        F.md5(prompting.rationale_prompt(F.col("doc"), F.col("genre"))).alias("rationale_md5"),
        F.md5(prompting.extraction_prompt(F.col("plot"))).alias("extract_md5"),
    )


@query(
    "first_n_reviews",
    """WITH f AS (SELECT source, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents QUALIFY rn <= 5)
SELECT source, md5('Summarise these reviews in 2-4 sentences and judge the overall sentiment.' || chr(10) || chr(10) || 'Reviews:' || chr(10)
  || string_agg(text, chr(10) || '---' || chr(10) ORDER BY rn) || chr(10) || chr(10) || 'Reply as:' || chr(10) || 'SUMMARY: ...' || chr(10)
  || 'SENTIMENT: positive, negative, mixed or neutral') AS prompt_md5 FROM f GROUP BY source""",
)
def _(spark, d):
    joined = prompting.first_n_reviews(table(spark, d, "documents"), "source", "doc_id", "text")
    return joined.select("source", F.md5(prompting.review_prompt(F.col("reviews"))).alias("prompt_md5"))


# ---- recorded responses: five strategies over every answered turn ----
def responses(spark: SparkSession, d: str) -> DataFrame:
    """query_id, query, answer, context, strategy, ordinal, response, reference, latency_ms, tokens_used, cached, error."""
    n = table(spark, d, "benchmark").count()
    conv = F.split_part("query_id", F.lit(":"), F.lit(1)).cast("long")
    turn = F.split_part("query_id", F.lit(":"), F.lit(2)).cast("long")
    reference = table(spark, d, "benchmark").select(F.col("item_id").alias("_ref"), F.col("text").alias("reference"))
    asked = tables.answered(spark, d).withColumn("_c", conv).withColumn("_t", turn)
    asked = asked.join(reference, F.col("_c") % n == F.col("_ref"), "left").drop("_ref")
    return attach(prompting.build_prompts(asked))


def attach(prompts: DataFrame) -> DataFrame:
    """A recorded answer per prompt; a third of them quote the first half of the reference, none holds all of it."""
    place = F.col("_c") + F.col("ordinal")
    failed = place % 9 == 0
    quoted = F.when(place % 3 == 0, F.expr("substring(reference, 1, cast(length(reference) div 2 as int))"))
    joined = prompts.withColumn("response", F.concat_ws(" ", F.col("strategy"), "answer", quoted))
    return joined.select(
        "query_id", "query", "context", "strategy", "ordinal", "response", "reference",
        (F.lit(50.0) * F.col("ordinal") + F.col("_t")).alias("latency_ms"),
        text.count_words_tokens(F.col("query"), F.col("response")).alias("tokens_used"),
        ((F.col("_c") % 4) == 0).alias("cached"),
        F.when(failed, F.lit("429 rate limit")).alias("error"),
    )


_NAMES = ", ".join(f"({lit(t.name)}, {i})" for i, t in enumerate(TEMPLATES, 1))
# longest common subsequence of the token lists a and b: a row of the table per token of a, as a running maximum
_LCS = """CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0 ELSE list_max(list_reduce(
    list_concat([list_transform(b, lambda u: 0)], list_transform(a, lambda t: list_transform(b, lambda u: CASE WHEN u = t THEN 1 ELSE 0 END))),
    lambda r, e: list_transform(range(1, len(r) + 1), lambda j: list_max(list_transform(range(1, j + 1),
      lambda i: greatest(r[i], coalesce(r[i - 1], 0) + e[i])))))) END"""
TOKENS = "list_filter(string_split_regex(lower({c}), '[^a-z0-9]+'), lambda t: t <> '')"


def recorded(answered: str) -> str:
    """The recorded answers and their scores over CTEs ``ctx`` (documents of a query) and ``answered``."""
    return f"""{answered}, base AS (
  SELECT a.*, CAST(split_part(query_id, ':', 1) AS BIGINT) AS c, CAST(split_part(query_id, ':', 2) AS BIGINT) AS t FROM answered a),
resp AS (SELECT b.query_id, b.query, strategy, ordinal, strategy || ' ' || answer
      || CASE WHEN (c + ordinal) % 3 = 0 THEN ' ' || substr(r.text, 1, length(r.text) // 2) ELSE '' END AS response, r.text AS reference,
    50.0::DOUBLE * ordinal + t AS latency_ms, c % 4 = 0 AS cached,
    CASE WHEN (c + ordinal) % 9 = 0 THEN '429 rate limit' END AS error
  FROM base b JOIN benchmark r ON r.item_id = c % (SELECT count(*) FROM benchmark), (VALUES {_NAMES}) s(strategy, ordinal)),
efacts AS (SELECT DISTINCT query_id, f FROM (
  SELECT query_id, lower(title) AS f FROM ctx UNION ALL SELECT query_id, lower(director) FROM ctx
  UNION ALL SELECT query_id, CAST(year AS VARCHAR) FROM ctx UNION ALL SELECT query_id, trim(unnest(string_split(lower(genre), '|'))) FROM ctx)),
fl AS (SELECT query_id, list(f) AS facts FROM efacts GROUP BY query_id),
cov AS (SELECT r.*, facts, CASE WHEN facts IS NULL THEN NULL
    ELSE len(list_filter(facts, lambda f: f <> '' AND contains(lower(response), f))) / len(facts) END AS coverage,
    len({words_sql('response')}) AS n_words, list_distinct({words_sql('lower(query)')}) AS terms,
    list_distinct({words_sql('lower(response)')}) AS rw, list_distinct({words_sql('lower(reference)')}) AS fw
  FROM resp r LEFT JOIN fl USING (query_id)),
ev AS (SELECT query_id, query, strategy, ordinal, response, latency_ms, cached, error,
    CASE WHEN coverage IS NULL THEN 3.0 WHEN coverage >= 0.4 THEN 5.0 WHEN coverage >= 0.3 THEN 4.0 WHEN coverage >= 0.2 THEN 3.0
         WHEN coverage >= 0.1 THEN 2.0 ELSE 1.0 END::DOUBLE AS factuality_score,
    least(5.0, greatest(1.0, 3.0 + CASE WHEN n_words BETWEEN 50 AND 300 THEN 0.5 WHEN n_words < 20 THEN -1.0 ELSE 0 END
      + CASE WHEN contains(response, '1.') OR contains(response, '•') OR contains(response, '-') OR contains(response, '**') THEN 0.5 ELSE 0 END
      + CASE WHEN contains(response, '[Source') OR contains(response, 'based on') OR contains(response, 'according to') THEN 0.5 ELSE 0 END
      + len(list_filter(terms, lambda t: contains(lower(response), t)))::DOUBLE / greatest(len(terms), 1)))::DOUBLE AS helpfulness_score,
    CASE WHEN len(rw) = 0 OR len(fw) = 0 THEN 0.0 ELSE len(list_intersect(rw, fw))::DOUBLE / len(list_distinct(list_concat(rw, fw))) END AS similarity,
    CAST(len({words_sql('query')}) + n_words AS BIGINT) AS tokens_used FROM cov),
lcs AS (SELECT query_id, strategy, len(a) AS n_pred, len(b) AS n_ref, {_LCS} AS n
  FROM (SELECT query_id, strategy, {TOKENS.format(c='response')} AS a, {TOKENS.format(c='reference')} AS b FROM resp)),
rouge AS (SELECT *, CASE WHEN rouge_l_precision > 0
    THEN 2::DOUBLE * rouge_l_precision * rouge_l_recall / (rouge_l_precision + rouge_l_recall) ELSE 0.0 END::DOUBLE AS rouge_l_f1
  FROM (SELECT query_id, strategy, n::DOUBLE / greatest(n_pred, 1) AS rouge_l_precision, n::DOUBLE / greatest(n_ref, 1) AS rouge_l_recall FROM lcs))"""


RESPONSES = recorded(ANSWERED)
ROUGE = ["rouge_l_precision", "rouge_l_recall", "rouge_l_f1"]


@query("factuality_score", f"WITH {RESPONSES} SELECT query_id, strategy, factuality_score AS score FROM ev")
def _(spark, d):
    s = scoring.factuality_score(F.col("response"), F.col("context"))
    return responses(spark, d).select("query_id", "strategy", s.alias("score"))


@query("helpfulness_score", f"WITH {RESPONSES} SELECT query_id, strategy, round(helpfulness_score, 6) AS score FROM ev")
def _(spark, d):
    s = scoring.helpfulness_score(F.col("response"), F.col("query"))
    return responses(spark, d).select("query_id", "strategy", F.round(s, 6).alias("score"))


@query(
    "relevance_score",
    f"WITH {RESPONSES} SELECT query_id, strategy, round((factuality_score + helpfulness_score) / 2, 6) AS score FROM ev",
)
def _(spark, d):
    f = scoring.factuality_score(F.col("response"), F.col("context"))
    h = scoring.helpfulness_score(F.col("response"), F.col("query"))
    return responses(spark, d).select("query_id", "strategy", F.round(scoring.relevance_score(f, h), 6).alias("score"))


@query("jaccard_words", f"WITH {RESPONSES} SELECT query_id, strategy, round(similarity, 6) AS similarity FROM ev")
def _(spark, d):
    s = text.jaccard_words(F.col("response"), F.col("reference"))
    return responses(spark, d).select("query_id", "strategy", F.round(s, 6).alias("similarity"))


@query(
    "word_set_union",
    f"""WITH {RESPONSES} SELECT query_id, strategy, CAST(len(list_distinct(list_concat(rw, fw))) AS INTEGER) AS n_union FROM cov""",
)
def _(spark, d):
    union = F.array_union(text.word_set(F.col("response")), text.word_set(F.col("reference")))
    return responses(spark, d).select("query_id", "strategy", F.size(union).alias("n_union"))


@query(
    "word_set_intersect",
    f"""WITH {RESPONSES} SELECT query_id, strategy, CAST(len(list_intersect(rw, fw)) AS INTEGER) AS n_shared FROM cov""",
)
def _(spark, d):
    shared = F.array_intersect(text.word_set(F.col("response")), text.word_set(F.col("reference")))
    return responses(spark, d).select("query_id", "strategy", F.size(shared).alias("n_shared"))


@query("rouge_l", f"WITH {RESPONSES} SELECT query_id, strategy, {', '.join(f'round({c}, 6) AS {c}' for c in ROUGE)} FROM rouge")
def _(spark, d):
    """ROUGE-L of every recorded answer against its reference."""
    r = scoring.rouge_l(F.col("response"), F.col("reference"))
    scored_ = responses(spark, d).select("query_id", "strategy", r.alias("r"))
    return scored_.select("query_id", "strategy", *[F.round(F.col("r")[c], 6).alias(c) for c in ROUGE])


@query(
    "rouge_tokens",
    """SELECT conv_id, turn, CAST(len(list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda t: t <> '')) AS INTEGER) AS n_tokens
FROM conversations""",
)
def _(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", F.size(scoring.rouge_tokens(F.col("text"))).alias("n_tokens"))


_SEVEN = {
    **{c: c for c in ROUGE}, "embedding_similarity": "similarity", "factuality_score": "factuality_score",
    "helpfulness_score": "helpfulness_score", "relevance_score": "(factuality_score + helpfulness_score) / 2",
}


@query(
    "evaluate_responses",
    f"""WITH {RESPONSES} SELECT query_id, strategy,
  {', '.join(f'CASE WHEN error IS NULL THEN round({v}, 6) ELSE 0.0 END AS {c}' for c, v in _SEVEN.items())}
FROM ev JOIN rouge USING (query_id, strategy)""",
)
def _(spark, d):
    """The seven scores of every recorded answer."""
    evaluated = evaluating.evaluate_responses(responses(spark, d))
    return evaluated.select("query_id", "strategy", *[F.round(c, 6).alias(c) for c in evaluating.SCORES])


@query(
    "evaluate_without_rouge",
    f"""WITH {RESPONSES} SELECT query_id, strategy, CASE WHEN error IS NULL THEN round(similarity, 6) ELSE 0.0 END AS embedding_similarity,
  CASE WHEN error IS NULL THEN factuality_score ELSE 0.0 END AS factuality_score,
  CASE WHEN error IS NULL THEN round(helpfulness_score, 6) ELSE 0.0 END AS helpfulness_score,
  CASE WHEN error IS NULL THEN round((factuality_score + helpfulness_score) / 2, 6) ELSE 0.0 END AS relevance_score FROM ev""",
)
def _(spark, d):
    e = evaluating.evaluate_responses(responses(spark, d), rouge=None)
    return e.select(
        "query_id", "strategy", *[F.round(c, 6).alias(c) for c in evaluating.SCORES if not c.startswith("rouge")]
    )


@query(
    "query_preview",
    f"""WITH {RESPONSES} SELECT query_id, strategy, CASE WHEN length(query) > 100 THEN substr(query, 1, 100) || '...' ELSE query END AS query,
  CAST(length(response) AS INTEGER) AS response_length, latency_ms, tokens_used, cached, error FROM ev""",
)
def _(spark, d):
    evaluated = evaluating.evaluate_responses(responses(spark, d), rouge=None)
    rows = evaluating.export_rows(evaluated.withColumn("strategy", F.struct("query_id", "strategy")))
    return rows.select("strategy.query_id", "strategy.strategy", "query", "response_length", "latency_ms", "tokens_used", "cached", "error")


def scored(spark: SparkSession, d: str) -> DataFrame:
    """Evaluated rows with the word overlap in the place of ROUGE, so that SQL can follow."""
    e = evaluating.evaluate_responses(responses(spark, d), rouge=None)
    return e.withColumn("rouge_l_f1", F.col("embedding_similarity"))


_SUMMARY = f"""{RESPONSES}, summary AS (SELECT strategy, ordinal, CAST(count(*) AS BIGINT) AS num_samples,
  coalesce(avg(similarity) FILTER (error IS NULL), 0.0) AS rouge_l_f1, coalesce(avg(similarity) FILTER (error IS NULL), 0.0) AS embedding_similarity,
  coalesce(avg(factuality_score) FILTER (error IS NULL), 0.0) AS factuality, coalesce(avg(helpfulness_score) FILTER (error IS NULL), 0.0) AS helpfulness,
  coalesce(avg(latency_ms) FILTER (error IS NULL), 0.0) AS latency_ms, CAST(sum(tokens_used) AS BIGINT) AS tokens,
  avg(CASE WHEN error IS NULL THEN 0.0 ELSE 1.0 END) AS error_rate FROM ev GROUP BY strategy, ordinal)"""
_EFFICIENCY = "(rouge_l_f1 + factuality / 5) / greatest(tokens, 1) * 10000"


@query(
    "summarize_strategies",
    f"""WITH {_SUMMARY} SELECT strategy, num_samples, round(rouge_l_f1, 6) AS rouge_l_f1, round(embedding_similarity, 6) AS embedding_similarity,
  round(factuality, 6) AS factuality, round(helpfulness, 6) AS helpfulness, round(latency_ms, 6) AS latency_ms, tokens,
  round(error_rate, 6) AS error_rate FROM summary""",
)
def _(spark, d):
    s = evaluating.summarize_strategies(scored(spark, d)).drop("ordinal")
    means = ["rouge_l_f1", "embedding_similarity", "factuality", "helpfulness", "latency_ms", "error_rate"]
    return s.withColumns({c: F.round(c, 6) for c in means})


_BEST = "(SELECT strategy FROM summary ORDER BY round({m}, 12) DESC, ordinal LIMIT 1)"


@query(
    "compare_strategies",
    f"""WITH {_SUMMARY} SELECT {_BEST.format(m='rouge_l_f1')} AS best_rouge_l, {_BEST.format(m='embedding_similarity')} AS best_embedding_sim,
  {_BEST.format(m='factuality')} AS best_factuality, {_BEST.format(m='helpfulness')} AS best_helpfulness,
  (SELECT strategy FROM summary WHERE latency_ms > 0 ORDER BY latency_ms, ordinal LIMIT 1) AS fastest,
  {_BEST.format(m=_EFFICIENCY)} AS most_efficient""",
)
def _(spark, d):
    return evaluating.compare_strategies(evaluating.summarize_strategies(scored(spark, d)))


@query(
    "sort_strategies",
    f"""WITH {_SUMMARY}, long AS (SELECT strategy, 'rouge_l' AS metric, rouge_l_f1 AS value FROM summary
  UNION ALL SELECT strategy, 'embedding_sim', embedding_similarity FROM summary UNION ALL SELECT strategy, 'factuality', factuality FROM summary
  UNION ALL SELECT strategy, 'helpfulness', helpfulness FROM summary UNION ALL SELECT strategy, 'speed', -latency_ms FROM summary
  UNION ALL SELECT strategy, 'efficiency', {_EFFICIENCY} FROM summary)
SELECT metric, strategy, CAST(rank() OVER (PARTITION BY metric ORDER BY round(value, 9) DESC) AS INTEGER) AS rank FROM long""",
)
def _(spark, d):
    return evaluating.sort_strategies(evaluating.summarize_strategies(scored(spark, d)))


@query(
    "fewshot_delta",
    f"""WITH {_SUMMARY}, p AS (SELECT max(rouge_l_f1) FILTER (strategy = 'few_shot_k3') AS a, max(rouge_l_f1) FILTER (strategy = 'few_shot_k5') AS b,
  max(factuality) FILTER (strategy = 'few_shot_k3') AS c, max(factuality) FILTER (strategy = 'few_shot_k5') AS d FROM summary)
SELECT round(a, 6) AS k3_rouge_l, round(b, 6) AS k5_rouge_l, round(c, 6) AS k3_factuality, round(d, 6) AS k5_factuality,
  b > a AS more_examples_better FROM p""",
)
def _(spark, d):
    row = evaluating.fewshot_delta(evaluating.summarize_strategies(scored(spark, d)))
    return row.withColumns({c: F.round(c, 6) for c in ("k3_rouge_l", "k5_rouge_l", "k3_factuality", "k5_factuality")})


_ASKED = f"""{QA}, {CORPUS},
d AS (SELECT id, lower(title) AS title, string_split(lower(genre), '|') AS genres, lower(director) AS director, lower(plot) AS plot FROM corpus),
q AS (SELECT query_id, lower(query) AS query FROM qa),
qw AS (SELECT query_id, word, count(*) AS n FROM (SELECT query_id, unnest(string_split_regex(query, '\\s+')) AS word FROM q)
  WHERE length(word) > 3 GROUP BY ALL),
wd AS (SELECT word, id FROM (SELECT DISTINCT word FROM qw) w JOIN d ON contains(d.plot, w.word)),
pts AS (SELECT query_id, id, 0.5 * sum(n) AS p FROM qw JOIN wd USING (word) GROUP BY ALL),
hits AS (SELECT q.query_id, d.id, CAST(coalesce(p, 0) + CASE WHEN contains(query, title) THEN 3 ELSE 0 END
    + CASE WHEN contains(query, director) THEN 2 ELSE 0 END + 2 * len(list_filter(genres, lambda g: contains(query, g))) AS DOUBLE) AS score
  FROM q CROSS JOIN d LEFT JOIN pts ON q.query_id = pts.query_id AND d.id = pts.id),
ctx AS (SELECT query_id, pos, c.* FROM (
    SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS pos FROM hits WHERE score > 0 QUALIFY pos <= 5)
  JOIN corpus c USING (id)),
answered AS (SELECT query_id, query, response AS answer FROM qa)"""
_MEANS = {
    "rouge_l_f1": "rouge_l_f1", "embedding_similarity": "similarity", "factuality": "factuality_score", "helpfulness": "helpfulness_score",
    "latency_ms": "latency_ms",
}


@query(
    "run_experiment",
    f"""WITH {recorded(_ASKED)} SELECT strategy, ordinal, CAST(count(*) AS BIGINT) AS num_samples,
  {', '.join(f'round(coalesce(avg({v}) FILTER (error IS NULL), 0.0), 6) AS {c}' for c, v in _MEANS.items())},
  CAST(sum(tokens_used) AS BIGINT) AS tokens, round(avg(CASE WHEN error IS NULL THEN 0.0 ELSE 1.0 END), 6) AS error_rate
FROM ev JOIN rouge USING (query_id, strategy) GROUP BY strategy, ordinal""",
)
def _(spark, d):
    """Strategies x every question, keyword context from the corpus, recorded answers, summary per strategy."""
    from tastegrid.operators.retrieval import keyword_context_join

    n = table(spark, d, "benchmark").count()
    reference = table(spark, d, "benchmark").select(F.col("item_id").alias("_ref"), F.col("text").alias("reference"))
    asked = tables.qa_pairs(spark, d).select(
        "query_id", "query", F.col("response").alias("answer"), F.col("conv_id").alias("_c"), F.col("turn").alias("_t")
    )
    asked = asked.join(reference, F.col("_c") % n == F.col("_ref"), "left").drop("_ref")
    corpus = tables.corpus(spark, d)

    def context(questions: DataFrame) -> DataFrame:
        hits = keyword_context_join(questions, corpus)
        fields = F.struct("rank", "id", "title", "genre", "year", "rating", "director", F.lit("").alias("cast"), "plot")
        # a document is copied to each question it answers; prompts show the head of its text and scores read none of it
        return hits.join(as_shown(corpus), "id").groupBy("query_id").agg(F.array_sort(F.collect_list(fields)).alias("context"))

    _, summary, _ = evaluating.run_experiment(asked, attach, context_provider=context)
    return summary.withColumns({c: F.round(c, 6) for c in [*_MEANS, "error_rate"]})


@query(
    "answer_from_responses",
    f"""WITH {ANSWERED}, mentions AS (
  SELECT a.query_id, count(c.id) AS n, coalesce(sum(CASE WHEN contains(lower(answer), lower(c.title)) THEN 1.0
    WHEN contains(lower(answer), lower(c.director)) THEN 0.5 ELSE 0.0 END), 0.0)::DOUBLE AS m,
    string_agg(CAST(c.id AS VARCHAR), ',' ORDER BY c.id) AS ids
  FROM answered a LEFT JOIN ctx c ON a.query_id = c.query_id GROUP BY a.query_id)
SELECT a.query_id, CASE WHEN n = 0 THEN {lit(evaluating.NO_ANSWER)} ELSE answer END AS answer, ids AS sources,
  n > 0 AND (m / greatest(n, 1) >= 0.25 OR m >= 1) AS grounded,
  CASE WHEN n = 0 THEN 'LOW' WHEN m / n >= 0.5 THEN 'HIGH' WHEN m / n >= 0.25 THEN 'MEDIUM' ELSE 'LOW' END AS confidence
FROM answered a JOIN mentions USING (query_id)""",
)
def _(spark, d):
    rows = evaluating.answer_from_responses(tables.answered(spark, d).withColumnRenamed("answer", "response"))
    ids = F.array_join(F.transform("sources", lambda s: s["id"].cast("string")), ",")
    return rows.select("query_id", "answer", ids.alias("sources"), "grounded", "confidence")


@query("max_samples", "SELECT item_id AS id, text FROM benchmark ORDER BY item_id LIMIT 20")
def _(spark, d):
    return cleaning.max_samples(table(spark, d, "benchmark").select(F.col("item_id").alias("id"), "text"), 20)


# ---- scalar text functions ----
@query("estimate_tokens", "SELECT doc_id, CAST(length(text) // 4 + 1 AS BIGINT) AS tokens FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", text.estimate_tokens(F.col("text")).alias("tokens"))


@query(
    "count_words_tokens",
    f"""WITH {ANSWERED} SELECT query_id, CAST(len({words_sql('query')}) + len({words_sql('answer')}) AS BIGINT) AS tokens FROM answered""",
)
def _(spark, d):
    n = text.count_words_tokens(F.col("query"), F.col("answer"))
    return tables.answered(spark, d).select("query_id", n.alias("tokens"))


@query(
    "truncate_ellipsis",
    """SELECT doc_id, CASE WHEN length(text) > 100 THEN substr(text, 1, 97) || '...' ELSE text END AS blurb,
  CASE WHEN length(l) > 100 THEN substr(l, 1, 97) || '...' ELSE l END AS rationale
FROM (SELECT *, split_part(trim(text, ' ' || chr(9) || chr(10) || chr(13)), chr(10), 1) AS l FROM documents)""",
)
def _(spark, d):
    c = F.col("text")
    return table(spark, d, "documents").select(
        "doc_id", text.truncate_ellipsis(c, 100).alias("blurb"), text.rationale_line(c).alias("rationale")
    )


_REPLY = "CASE WHEN doc_id % 3 = 0 THEN 'SUMMARY: ' || text || chr(10) || 'SENTIMENT: Mixed ' WHEN doc_id % 3 = 1 THEN 'SUMMARY: ' || text ELSE text END"


@query(
    "parse_summary_sentiment",
    f"""WITH r AS (SELECT doc_id, {_REPLY} AS t FROM documents), p AS (SELECT doc_id, t, string_split(t, 'SENTIMENT:') AS p FROM r)
SELECT doc_id, CASE WHEN contains(t, 'SUMMARY:') THEN trim(replace(p[1], 'SUMMARY:', ''), ' ' || chr(9) || chr(10) || chr(13))
    ELSE 'Review summary not available.' END AS summary,
  CASE WHEN contains(t, 'SUMMARY:') AND len(p) > 1 THEN lower(trim(p[2], ' ' || chr(9) || chr(10) || chr(13))) ELSE 'neutral' END AS sentiment FROM p""",
)
def _(spark, d):
    body = F.concat(F.lit("SUMMARY: "), F.col("text"))
    reply = (
        F.when(F.col("doc_id") % 3 == 0, F.concat(body, F.lit("\nSENTIMENT: Mixed ")))
        .when(F.col("doc_id") % 3 == 1, body)
        .otherwise(F.col("text"))
    )
    parsed = table(spark, d, "documents").select("doc_id", text.parse_summary_sentiment(reply).alias("p"))
    return parsed.select("doc_id", "p.summary", "p.sentiment")


@query(
    "parse_json_response",
    """SELECT doc_id, CASE WHEN doc_id % 4 < 3 THEN source END AS title, CASE WHEN doc_id % 4 < 3 THEN CAST(1990 + doc_id % 35 AS INTEGER) ELSE 0 END AS year,
  CASE WHEN doc_id % 4 < 3 THEN lang || ',x' END AS genres, doc_id % 4 = 3 AS failed FROM documents""",
)
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    body = F.to_json(
        F.struct(
            F.col("source").alias("title"),
            (F.lit(1990) + F.col("doc_id") % 35).alias("year"),
            F.array(F.col("lang"), F.lit("x")).alias("genres"),
        )
    )
    kind = F.col("doc_id") % 4
    reply = (
        F.when(kind == 0, body)
        .when(kind == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(kind == 2, F.concat(F.lit("  ```\n"), body, F.lit("```  ")))
        .otherwise(F.concat(F.lit("Sorry: "), body))
    )
    parsed = docs.select("doc_id", text.parse_json_response(reply, EXTRACTED_ITEM).alias("p"))
    return parsed.select(
        "doc_id", "p.title", F.coalesce("p.year", F.lit(0)).alias("year"), F.array_join("p.genres", ",").alias("genres"), F.col("p.title").isNull().alias("failed")
    )


_KEY = """sha256('{"max_tokens":500,"prompt":' || to_json(props) || ',"system":' || to_json(event_type) || ',"temperature":0.3}')"""


def keyed(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    key = hashing.cache_key(prompt=F.col("props"), system=F.col("event_type"), temperature=F.lit(0.3).cast("double"), max_tokens=F.lit(500))
    return e.select("event_id", instant("ts").alias("ts"), "event_type", "value", key.alias("cache_key"))


@query("cache_key", f"SELECT event_id, {_KEY} AS cache_key FROM events")
def _(spark, d):
    return keyed(spark, d).select("event_id", "cache_key")


_CACHE = f"""k AS (SELECT event_id, ts, value, {_KEY} AS cache_key FROM events),
cache AS (SELECT cache_key, arg_max(value, ts) AS response, max(ts) AS stored FROM k WHERE ts < TIMESTAMP '2024-01-16' GROUP BY cache_key),
looked AS (SELECT event_id, k.cache_key, ts, coalesce(ts >= stored AND ts - stored < INTERVAL 1 DAY, false) AS cached, response
  FROM k LEFT JOIN cache USING (cache_key) WHERE ts >= TIMESTAMP '2024-01-16')"""


def lookup(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    k = keyed(spark, d)
    half = F.lit("2024-01-16").cast("timestamp")
    cache = k.where(F.col("ts") < half).groupBy("cache_key").agg(F.max_by("value", "ts").alias("response"), F.max("ts").alias("ts"))
    return caching.cache_lookup(k.where(F.col("ts") >= half).drop("value", "event_type"), cache), cache


@query(
    "cache_lookup",
    f"WITH {_CACHE} SELECT event_id, cache_key, cached, CASE WHEN cached THEN response END AS response FROM looked",
)
def _(spark, d):
    return lookup(spark, d)[0].select("event_id", "cache_key", "cached", "response")


@query(
    "cache_misses",
    f"""WITH {_CACHE} SELECT cache_key, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY cache_key ORDER BY ts, event_id) AS rn FROM looked WHERE NOT cached) WHERE rn = 1""",
)
def _(spark, d):
    return caching.cache_misses(lookup(spark, d)[0]).select("cache_key", "event_id")


@query(
    "cache_refill",
    f"""WITH {_CACHE}, fresh AS (SELECT cache_key, CAST(event_id AS DOUBLE) AS response, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY cache_key ORDER BY ts, event_id) AS rn FROM looked WHERE NOT cached) WHERE rn = 1)
SELECT cache_key, arg_max(response, ts) AS response FROM (
  SELECT cache_key, response, stored AS ts FROM cache UNION ALL SELECT cache_key, response, ts FROM fresh) GROUP BY cache_key""",
)
def _(spark, d):
    looked, cache = lookup(spark, d)
    fresh = caching.cache_misses(looked).withColumn("response", F.col("event_id").cast("double"))
    return caching.cache_refill(cache, fresh).select("cache_key", "response")


# ---- A/B ----


def bucket_sql(user: str, experiment: str = "prompt_experiment") -> str:
    folded = "0"
    for i in range(4):
        piece = f"CAST('0x' || substr(md5('{experiment}:' || {user}), {8 * i + 1}, 8) AS BIGINT)"
        folded = f"(({folded}) * 296 + {piece}) % 1000"
    return f"CAST({folded} AS DOUBLE) / 1000.0"


_VARIANT = f"""(CASE WHEN {bucket_sql('user_id')} < 0.2 THEN 'zero_shot' WHEN {bucket_sql('user_id')} < 0.5 THEN 'few_shot_k3' ELSE 'meta_prompt' END)"""


@query("ab_bucket", f"SELECT user_id, {bucket_sql('user_id')} AS bucket FROM (SELECT c_custkey AS user_id FROM customer)")
def _(spark, d):
    u = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    return u.select("user_id", hashing.ab_bucket(F.lit("prompt_experiment"), F.col("user_id")).alias("bucket"))


@query(
    "ab_assign",
    f"""SELECT user_id, {_VARIANT} AS variant, 'b' AS disabled, 'default' AS missing FROM (SELECT c_custkey AS user_id FROM customer)""",
)
def _(spark, d):
    u = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    paused = {"paused": {"enabled": False, "variants": ["a", "b"], "weights": [0.5, 0.5]}}
    return u.select(
        "user_id",
        abtest.ab_assign("prompt_experiment", F.col("user_id")).alias("variant"),
        abtest.ab_assign("paused", F.col("user_id"), paused).alias("disabled"),
        abtest.ab_assign("none", F.col("user_id")).alias("missing"),
    )


def assigned(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(
        F.lit("prompt_experiment").alias("experiment"),
        abtest.ab_assign("prompt_experiment", F.col("user_id")).alias("variant"),
        "event_type",
    )


@query(
    "ab_impressions",
    f"""SELECT 'prompt_experiment' AS experiment, {_VARIANT} AS variant, CAST(count(*) AS BIGINT) AS impressions
FROM events WHERE event_type = 'view' GROUP BY ALL""",
)
def _(spark, d):
    return abtest.ab_impressions(assigned(spark, d).where("event_type = 'view'"))


@query(
    "conversion_by_variant",
    f"""SELECT experiment, variant, impressions, conversions, round(conversions / impressions, 6) AS conversion_rate FROM (
  SELECT 'prompt_experiment' AS experiment, {_VARIANT} AS variant, CAST(count(*) FILTER (event_type = 'view') AS BIGINT) AS impressions,
    CAST(count(*) FILTER (event_type = 'purchase') AS BIGINT) AS conversions FROM events GROUP BY ALL)""",
)
def _(spark, d):
    kind = F.col("event_type")
    r = abtest.conversion_by_variant(assigned(spark, d), kind == "view", kind == "purchase")
    return r.withColumn("conversion_rate", F.round("conversion_rate", 6))


# ---- request validation ----
@query(
    "validate_requests",
    f"""WITH {CORPUS}, q AS (SELECT conv_id, turn, text AS query, CAST(turn * 7 AS INTEGER) AS top_k, CASE WHEN conv_id % 5 > 0 THEN CAST(1890 + conv_id % 160 AS INTEGER) END AS year_min FROM conversations)
SELECT conv_id, turn, array_to_string(r, ',') AS reject_reason, len(r) = 0 AS valid FROM (
  SELECT conv_id, turn, list_filter([CASE WHEN length(query) NOT BETWEEN 1 AND 500 THEN 'query' END,
    CASE WHEN top_k NOT BETWEEN 1 AND 50 THEN 'top_k' END, CASE WHEN year_min NOT BETWEEN 1900 AND 2030 THEN 'year_min' END],
    lambda x: x IS NOT NULL) AS r FROM q)""",
)
def _(spark, d):
    q = table(spark, d, "conversations").select(
        "conv_id",
        "turn",
        F.col("text").alias("query"),
        (F.col("turn") * 7).cast("int").alias("top_k"),
        F.when(F.col("conv_id") % 5 > 0, (F.lit(1890) + F.col("conv_id") % 160).cast("int")).alias("year_min"),
    )
    checked = cleaning.validate_requests(q, "search")
    return checked.select("conv_id", "turn", F.array_join("reject_reason", ",").alias("reject_reason"), "valid")
