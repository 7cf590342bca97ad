"""Guardrail queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.functions import guards, text
from tastegrid.operators import guarding
from tastegrid.plans.registry import CORPUS, QA, query
from tastegrid.sources import tables
from tastegrid.sources.tables import table


def lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


SCREENED = f"""screened AS (SELECT doc_id, [{', '.join(lit(x) for x in tables.LEADS)}][CAST(doc_id % {len(tables.LEADS)} + 1 AS INTEGER)]
  || chr(10) || text AS text FROM documents)"""
ANSWERED = f"""{QA}, {CORPUS}, wanted AS (
  SELECT DISTINCT query_id, conv_id + turn * 7 + i * 11 AS id FROM qa, (VALUES (0), (1), (2)) n(i)),
ctx AS (SELECT w.query_id, row_number() OVER (PARTITION BY w.query_id ORDER BY c.id) AS pos, c.* FROM wanted w JOIN corpus c ON w.id = c.id),
answered AS (SELECT q.query_id, q.query, CASE WHEN q.turn % 4 = 0 AND f.id IS NOT NULL
    THEN 'Based on ' || f.director || ' of 1999, 2001, 1987 and ' || f.year || ', here is a list:' || chr(10) || '1. ' || response
    ELSE response END AS answer
  FROM qa q LEFT JOIN (SELECT * FROM ctx WHERE pos = 1) f ON q.query_id = f.query_id)"""
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def n_matches(pattern: str, column: str = "text") -> str:
    return f"len(regexp_extract_all({column}, {lit('(?i)' + pattern)}))"


def found(pattern: str, column: str = "text") -> str:
    return f"regexp_matches({column}, {lit('(?i)' + pattern)})"


def redacted(labels: dict[str, str], column: str = "text") -> str:
    out = column
    for kind, pattern in guards.PII:
        out = f"regexp_replace({out}, {lit('(?i)' + pattern)}, {lit(labels[kind])}, 'g')"
    return out


_VALIDATOR_LABELS = {t: f"[REDACTED_{t.upper()}]" for t, _ in guards.PII}


@query(
    "pii_detect",
    f"WITH {SCREENED} SELECT doc_id, type, CAST(n AS INTEGER) AS count FROM ("
    + " UNION ALL ".join(
        f"SELECT doc_id, {lit(guards.PII_FILTER_NAMES.get(t, t))} AS type, {n_matches(p)} AS n FROM screened" for t, p in guards.PII
    )
    + ") WHERE n > 0",
)
def _(spark, d):
    found_ = tables.screened_texts(spark, d).select("doc_id", F.explode(guards.pii_detect(F.col("text"))).alias("d"))
    return found_.select("doc_id", "d.type", "d.count")


@query("pii_redact", f"WITH {SCREENED} SELECT doc_id, {redacted(guards.PII_LABELS)} AS filtered_text FROM screened")
def _(spark, d):
    return tables.screened_texts(spark, d).select("doc_id", guards.pii_redact(F.col("text")).alias("filtered_text"))


@query(
    "pii_redact_pages",
    f"SELECT page_id, md5({redacted(guards.PII_LABELS, 'html')}) AS filtered_md5 FROM pages",
)
def _(spark, d):
    return tables.texts(spark, d, "pages", "page_id").select("page_id", F.md5(guards.pii_redact(F.col("html"))).alias("filtered_md5"))


@query("pii_redact_validator", f"WITH {SCREENED} SELECT doc_id, {redacted(_VALIDATOR_LABELS)} AS sanitized FROM screened")
def _(spark, d):
    return tables.screened_texts(spark, d).select("doc_id", guards.pii_redact_validator(F.col("text")).alias("sanitized"))


_HIGH, _MEDIUM, _LOW = (
    " OR ".join(found(p) for p, s in guards.INJECTION_LEVELS if s == level) for level in ("high", "medium", "low")
)
_SEVERITY = f"CASE WHEN {_HIGH} THEN 'high' WHEN {_MEDIUM} THEN 'medium' WHEN {_LOW} THEN 'low' ELSE 'none' END"


@query(
    "injection_severity",
    f"""WITH {SCREENED}, s AS (SELECT doc_id, {_SEVERITY} AS max_severity FROM screened)
SELECT doc_id, max_severity, max_severity IN ('none', 'low') AS passed FROM s""",
)
def _(spark, d):
    checked = tables.screened_texts(spark, d).select("doc_id", guards.injection_filter(F.col("text")).alias("r"))
    return checked.select("doc_id", "r.max_severity", "r.passed")


@query(
    "injection_detections",
    f"WITH {SCREENED} SELECT doc_id, pattern, severity, CAST(n AS INTEGER) AS matches FROM ("
    + " UNION ALL ".join(
        f"SELECT doc_id, {lit(p)} AS pattern, {lit(s)} AS severity, {n_matches(p)} AS n FROM screened"
        for p, s in guards.INJECTION_LEVELS
    )
    + ") WHERE n > 0",
)
def _(spark, d):
    hits = tables.screened_texts(spark, d).select("doc_id", F.explode(guards.injection_detect(F.col("text"))).alias("x"))
    return hits.select("doc_id", "x.pattern", "x.severity", "x.matches")


_BLOCKER = "CASE " + " ".join(f"WHEN {found(p)} THEN {lit(p)}" for p in guards.INJECTION_BLOCKERS) + " END"


@query("injection_block", f"WITH {SCREENED} SELECT doc_id, {_BLOCKER} AS pattern FROM screened")
def _(spark, d):
    return tables.screened_texts(spark, d).select("doc_id", guards.injection_block(F.col("text")).alias("pattern"))


_WORDS = "[" + ", ".join(lit(w) for w in guards.TOXIC_WORDS) + "]"
_OUT_WORD = "CASE " + " ".join(f"WHEN contains(lower({{c}}), {lit(w)}) THEN {lit(w)}" for w in guards.TOXIC_WORDS_OUTPUT) + " END"


@query(
    "toxicity_keywords",
    f"""WITH {SCREENED}, f AS (SELECT doc_id, list_filter({_WORDS}, lambda k: contains(lower(text), k)) AS w FROM screened)
SELECT doc_id, array_to_string(w, ',') AS found_keywords, len(w) = 0 AS passed FROM f""",
)
def _(spark, d):
    checked = tables.screened_texts(spark, d).select("doc_id", guards.toxicity_filter(F.col("text")).alias("r"))
    return checked.select("doc_id", F.array_join("r.found_keywords", ",").alias("found_keywords"), "r.passed")


@query("toxicity_keywords_output", f"WITH {SCREENED} SELECT doc_id, {_OUT_WORD.format(c='text')} AS keyword FROM screened")
def _(spark, d):
    return tables.screened_texts(spark, d).select("doc_id", guards.toxicity_keywords_output(F.col("text")).alias("keyword"))


def toxicity_table(spark: SparkSession, d: str) -> DataFrame:
    """Labels read as classifier scores: a map of three categories per labelled document."""
    lab = table(spark, d, "labels")
    scores = F.create_map(
        F.lit("toxicity"), F.col("toxic") * 0.9 + (F.col("doc_id") % 10) / 100.0,
        F.lit("insult"), (F.col("doc_id") % 71) / 100.0,
        F.lit("threat"), F.lit(0.7) * F.col("quality"),
    )
    return lab.select("doc_id", scores.alias("scores"))


@query(
    "toxicity_scores",
    """WITH s AS (SELECT doc_id, 'toxicity' AS k, toxic * 0.9::DOUBLE + (doc_id % 10) / 100.0 AS v, 1 AS o FROM labels
  UNION ALL SELECT doc_id, 'insult', (doc_id % 71) / 100.0, 2 FROM labels
  UNION ALL SELECT doc_id, 'threat', 0.7::DOUBLE * quality, 3 FROM labels),
top AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY v DESC, o) = 1)
SELECT doc_id, k AS max_category, round(v, 6) AS max_score, v < 0.7::DOUBLE AS passed, v > 0.7::DOUBLE AS violation FROM top""",
)
def _(spark, d):
    r = toxicity_table(spark, d).select("doc_id", guards.toxicity_scores(F.col("scores")).alias("r")).select("doc_id", "r.*")
    return r.withColumn("max_score", F.round("max_score", 6))


@query(
    "content_policy",
    f"WITH {SCREENED} SELECT doc_id, category, pattern FROM ("
    + " UNION ALL ".join(
        f"SELECT doc_id, {lit(c)} AS category, {lit(p)} AS pattern FROM screened WHERE {found(p)}" for c, p in guards.POLICY
    )
    + ")",
)
def _(spark, d):
    hits = tables.screened_texts(spark, d).select("doc_id", F.explode(guards.content_policy(F.col("text"))).alias("v"))
    return hits.select("doc_id", "v.category", "v.pattern")


_FACTS = """facts AS (
  SELECT DISTINCT query_id, f FROM (
    SELECT query_id, lower(title) AS f FROM ctx WHERE title <> ''
    UNION ALL SELECT query_id, unnest(list_filter(string_split_regex(lower(title), '\\s+'), lambda w: length(w) > 3)) FROM ctx
    UNION ALL SELECT query_id, lower(director) FROM ctx WHERE director <> ''
    UNION ALL SELECT query_id, CAST(year AS VARCHAR) FROM ctx
    UNION ALL SELECT query_id, trim(unnest(string_split(lower(genre), '|'))) FROM ctx WHERE genre <> ''))"""
_CLAIMS = f"""claims AS (SELECT query_id, n, claim FROM (
  SELECT query_id, unnest(range(1, len(p) + 1)) AS n, trim(unnest(p), {BLANKS}) AS claim
  FROM (SELECT query_id, string_split_regex(answer, '[.!?]') AS p FROM answered)) WHERE length(claim) > 20)"""


@query("context_facts", f"WITH {ANSWERED}, {_FACTS} SELECT query_id, f AS fact FROM facts")
def _(spark, d):
    return tables.answered(spark, d).select("query_id", F.explode(guards.context_facts(F.col("context"))).alias("fact"))


@query("extract_claims", f"WITH {ANSWERED}, {_CLAIMS} SELECT query_id, claim FROM claims")
def _(spark, d):
    return tables.answered(spark, d).select("query_id", F.explode(guards.extract_claims(F.col("answer"))).alias("claim"))


_CHECKED = f"""WITH {ANSWERED}, {_FACTS}, {_CLAIMS}, g AS (
  SELECT query_id, n, claim, EXISTS (SELECT 1 FROM facts f WHERE f.query_id = c.query_id AND contains(lower(c.claim), f.f)) AS ok
  FROM claims c),
tot AS (SELECT a.query_id, count(claim) AS total, count(claim) FILTER (ok) AS grounded,
    a.query_id IN (SELECT query_id FROM ctx) AS has_context FROM answered a LEFT JOIN g USING (query_id) GROUP BY a.query_id)"""


@query(
    "hallucination_check",
    f"""{_CHECKED} SELECT query_id, NOT has_context AS skipped, NOT has_context OR grounded / greatest(total, 1) >= 0.5 AS passed,
  CASE WHEN has_context THEN CAST(total AS INTEGER) END AS total_claims,
  CASE WHEN has_context THEN CAST(grounded AS INTEGER) END AS grounded_claims,
  CASE WHEN has_context THEN round(grounded / greatest(total, 1), 6) END AS grounding_ratio FROM tot""",
)
def _(spark, d):
    r = guards.hallucination_check(F.col("answer"), F.col("context"))
    out = tables.answered(spark, d).select("query_id", r.alias("r")).select("query_id", "r.*").drop("ungrounded_claims")
    return out.withColumn("grounding_ratio", F.round("grounding_ratio", 6))


@query(
    "hallucination_check_strict",
    f"""{_CHECKED}, loose AS (SELECT query_id, list(claim ORDER BY n) AS l FROM g WHERE NOT ok GROUP BY query_id)
SELECT query_id, NOT has_context OR grounded = total AS passed,
  CASE WHEN has_context THEN md5(coalesce(array_to_string(l[1:5], '|'), '')) END AS ungrounded_md5
FROM tot LEFT JOIN loose USING (query_id)""",
)
def _(spark, d):
    r = guards.hallucination_check(F.col("answer"), F.col("context"), strict=True)
    out = tables.answered(spark, d).select("query_id", r.alias("r"))
    return out.select("query_id", "r.passed", F.md5(F.array_join("r.ungrounded_claims", "|")).alias("ungrounded_md5"))


@query(
    "grounding_ratio",
    f"{_CHECKED} SELECT query_id, round(grounded / greatest(total, 1), 6) AS grounding_ratio FROM tot WHERE has_context",
)
def _(spark, d):
    r = guards.grounding_ratio(F.col("answer"), F.col("context"))
    return tables.answered(spark, d).where(F.size("context") > 0).select("query_id", F.round(r, 6).alias("grounding_ratio"))


_GROUNDING = f"""{ANSWERED}, mentions AS (
  SELECT a.query_id, count(c.id) AS n, coalesce(sum(CASE WHEN contains(lower(answer), lower(c.title)) THEN 1.0
    WHEN contains(lower(answer), lower(c.director)) THEN 0.5 ELSE 0.0 END), 0.0)::DOUBLE AS mentions
  FROM answered a LEFT JOIN ctx c ON a.query_id = c.query_id GROUP BY a.query_id),
ground AS (SELECT query_id, mentions, CASE WHEN n > 0 THEN mentions / n ELSE 0.0 END AS ratio FROM mentions)"""
_CONFIDENCE = "CASE WHEN ratio >= 0.5 THEN 'HIGH' WHEN ratio >= 0.25 THEN 'MEDIUM' ELSE 'LOW' END"


@query(
    "assess_grounding",
    f"""WITH {_GROUNDING} SELECT query_id, mentions, round(ratio, 6) AS ratio, ratio >= 0.25 OR mentions >= 1 AS grounded,
  {_CONFIDENCE} AS confidence FROM ground""",
)
def _(spark, d):
    r = guards.assess_grounding(F.col("answer"), F.col("context"))
    out = tables.answered(spark, d).select("query_id", r.alias("r")).select("query_id", "r.*")
    return out.withColumn("ratio", F.round("ratio", 6))


_YEARS = """years AS (SELECT DISTINCT query_id, y FROM (
  SELECT query_id, unnest(regexp_extract_all(answer, '\\b((?:19|20)\\d{2})\\b', 1)) AS y FROM answered) t
  WHERE NOT EXISTS (SELECT 1 FROM ctx c WHERE c.query_id = t.query_id AND CAST(c.year AS VARCHAR) = y)),
nyears AS (SELECT query_id, count(*) AS n, string_agg(y, ',' ORDER BY y) AS ys FROM years GROUP BY query_id)"""


@query("unsupported_years", f"WITH {ANSWERED}, {_YEARS} SELECT query_id, ys AS years, n > 2 AS warning FROM nyears")
def _(spark, d):
    years = guards.unsupported_years(F.col("answer"), F.col("context"))
    rows = tables.answered(spark, d).select("query_id", years.alias("y")).where(F.size("y") > 0)
    return rows.select("query_id", F.array_join(F.array_sort("y"), ",").alias("years"), (F.size("y") > 2).alias("warning"))


@query(
    "year_set_except",
    f"WITH {ANSWERED}, {_YEARS} SELECT query_id, y AS year FROM years",
)
def _(spark, d):
    years = guards.unsupported_years(F.col("answer"), F.col("context"))
    return tables.answered(spark, d).select("query_id", F.explode(years).alias("year"))


_SILENT = """silent AS (SELECT a.query_id, count(*) FILTER (c.title <> '') > 0
    AND count(*) FILTER (c.title <> '' AND contains(lower(answer), lower(c.title))) = 0 AS silent
  FROM answered a LEFT JOIN ctx c ON a.query_id = c.query_id GROUP BY a.query_id)"""


@query("context_unreferenced", f"WITH {ANSWERED}, {_SILENT} SELECT query_id, silent AS unreferenced FROM silent")
def _(spark, d):
    r = guards.context_unreferenced(F.col("answer"), F.col("context"))
    return tables.answered(spark, d).select("query_id", r.alias("unreferenced"))


@query(
    "length_limit",
    """SELECT doc_id, length(text) > 2000 AS too_long, md5(CASE WHEN length(text) > 2000 THEN substr(text, 1, 2000) ELSE text END) AS cut_md5
FROM documents""",
)
def _(spark, d):
    c = F.col("text")
    cut = F.when(F.length(c) > guards.MAX_INPUT_LENGTH, F.substring(c, 1, guards.MAX_INPUT_LENGTH)).otherwise(c)
    warned = F.size(guards.length_violations(c, "input_length", guards.MAX_INPUT_LENGTH)) > 0
    return table(spark, d, "documents").select("doc_id", warned.alias("too_long"), F.md5(cut).alias("cut_md5"))


_INPUT_VIOLATIONS = (
    "SELECT doc_id, 'input_length' AS guardrail_type, 'warning' AS severity FROM screened WHERE length(text) > 2000"
    + "".join(
        f" UNION ALL SELECT doc_id, 'pii_{t}', 'warning' FROM screened WHERE {n_matches(p)} > 0" for t, p in guards.PII
    )
    + f" UNION ALL SELECT doc_id, 'prompt_injection', 'critical' FROM screened WHERE {_BLOCKER} IS NOT NULL"
)


@query(
    "validate_input",
    f"""WITH {SCREENED}, v AS ({_INPUT_VIOLATIONS}), n AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (severity = 'critical') AS bad FROM v GROUP BY doc_id),
r AS (SELECT doc_id, text, {redacted(_VALIDATOR_LABELS)} AS clean FROM screened)
SELECT r.doc_id, coalesce(bad, 0) = 0 AS passed, CAST(coalesce(n, 0) AS INTEGER) AS n_violations,
  md5(CASE WHEN length(text) > 2000 THEN substr(clean, 1, 2000) ELSE clean END) AS sanitized_md5 FROM r LEFT JOIN n USING (doc_id)""",
)
def _(spark, d):
    checked = tables.screened_texts(spark, d).select("doc_id", guards.validate_input(F.col("text")).alias("r"))
    return checked.select(
        "doc_id", "r.passed", F.size("r.violations").alias("n_violations"), F.md5("r.sanitized_text").alias("sanitized_md5")
    )


@query(
    "violation_counts",
    f"""WITH {SCREENED}, v AS ({_INPUT_VIOLATIONS})
SELECT guardrail_type, severity, CAST(count(*) AS BIGINT) AS n FROM v GROUP BY ALL""",
)
def _(spark, d):
    checked = tables.screened_texts(spark, d).select(guards.validate_input(F.col("text")).alias("result"))
    return guarding.violation_counts(checked)


@query(
    "check_counts",
    f"""WITH {SCREENED} SELECT 'input' AS guardrail_type, CASE WHEN {_BLOCKER} IS NULL THEN 'pass' ELSE 'fail' END AS result,
  CAST(count(*) AS BIGINT) AS n FROM screened GROUP BY ALL""",
)
def _(spark, d):
    checked = tables.screened_texts(spark, d).select(guards.validate_input(F.col("text")).alias("result"))
    return guarding.check_counts(checked, "input")


_OUTPUT_VIOLATIONS = f"""SELECT query_id, 'output_length' AS kind, 'warning' AS severity FROM answered WHERE length(answer) > 5000
  UNION ALL SELECT query_id, 'toxicity', 'warning' FROM answered WHERE {_OUT_WORD.format(c='answer')} IS NOT NULL
  UNION ALL SELECT query_id, 'hallucination', 'warning' FROM nyears WHERE n > 2 AND query_id IN (SELECT query_id FROM ctx)
  UNION ALL SELECT query_id, 'hallucination', 'info' FROM silent WHERE silent"""


@query(
    "validate_output",
    f"""WITH {ANSWERED}, {_YEARS}, {_SILENT}, v AS ({_OUTPUT_VIOLATIONS})
SELECT query_id, true AS passed, coalesce(string_agg(kind || ':' || severity, ',' ORDER BY kind, severity), '') AS violations
FROM answered LEFT JOIN v USING (query_id) GROUP BY query_id""",
)
def _(spark, d):
    checked = tables.answered(spark, d).select("query_id", guards.validate_output(F.col("answer"), F.col("context")).alias("r"))
    kinds = F.transform("r.violations", lambda v: F.concat(v["guardrail_type"], F.lit(":"), v["severity"]))
    return checked.select("query_id", "r.passed", F.array_join(F.array_sort(kinds), ",").alias("violations"))


@query(
    "validate_output_scores",
    """SELECT doc_id, greatest(toxic * 0.9::DOUBLE + (doc_id % 10) / 100.0, (doc_id % 71) / 100.0, 0.7::DOUBLE * quality) <= 0.7::DOUBLE AS passed,
  CAST(CASE WHEN length(text) > 5000 THEN 1 ELSE 0 END
    + CASE WHEN greatest(toxic * 0.9::DOUBLE + (doc_id % 10) / 100.0, (doc_id % 71) / 100.0, 0.7::DOUBLE * quality) > 0.7::DOUBLE THEN 1 ELSE 0 END
    AS INTEGER) AS n_violations FROM documents JOIN labels USING (doc_id)""",
)
def _(spark, d):
    joined = table(spark, d, "documents").select("doc_id", "text").join(toxicity_table(spark, d), "doc_id")
    checked = joined.select("doc_id", guards.validate_output(F.col("text"), scores=F.col("scores")).alias("r"))
    return checked.select("doc_id", "r.passed", F.size("r.violations").alias("n_violations"))


@query(
    "qa_verdict",
    f"""WITH {_GROUNDING}, r AS (SELECT query_id, {_BLOCKER.replace('(text,', '(query,')} IS NULL AS ok FROM answered)
SELECT query_id, CASE WHEN ok THEN 'answered' ELSE 'rejected' END AS status,
  CASE WHEN ok THEN ratio >= 0.25 OR mentions >= 1 END AS grounded, CASE WHEN ok THEN {_CONFIDENCE} END AS confidence,
  CASE WHEN ok THEN CAST((SELECT count(*) FROM ctx c WHERE c.query_id = g.query_id) AS INTEGER) END AS n_sources
FROM ground g JOIN r USING (query_id)""",
)
def _(spark, d):
    rows = guarding.qa_verdict(tables.answered(spark, d), "query", "answer", "context")
    n = F.when(F.col("status") == "answered", F.size("sources"))
    return rows.select("query_id", "status", "grounded", "confidence", n.alias("n_sources"))


@query(
    "register_filter",
    f"""WITH {SCREENED} SELECT doc_id, length(text) > 3000 AS long_text, {_SEVERITY} IN ('none', 'low') AS injection_passed,
  len(list_filter({_WORDS}, lambda k: contains(lower(text), k))) = 0 AS toxicity_passed FROM screened""",
)
def _(spark, d):
    """A filter added by the caller runs next to the built-in ones."""
    guarding.register_filter(
        "long_text",
        lambda c: F.struct((F.length(c) <= 3000).alias("passed"), F.lit("length").alias("message")),
    )
    names = ["long_text", "prompt_injection_filter", "toxicity_filter"]
    checked = guarding.apply_filters(tables.screened_texts(spark, d), "text", names)
    return checked.select(
        "doc_id",
        (~F.col("long_text.passed")).alias("long_text"),
        F.col("prompt_injection_filter.passed").alias("injection_passed"),
        F.col("toxicity_filter.passed").alias("toxicity_passed"),
    )
