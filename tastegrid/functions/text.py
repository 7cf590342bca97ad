"""Text expressions: Column -> Column, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tastegrid.functions.binding import let_all


def blank(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def words(c: Column) -> Column:
    """Whitespace-separated words, no empty ones."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")


def word_set(c: Column) -> Column:
    return F.array_distinct(words(F.lower(c)))


def split_genres(c: Column) -> Column:
    """``'a | b'`` -> ``['a','b']``; null -> []."""
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(
        F.transform(F.split(c, r"\|"), lambda g: F.trim(g))
    )


def doc_content(title: Column, genre: Column, year: Column, director: Column, plot: Column) -> Column:
    """The searchable text of one document."""
    labelled = [("Title", title), ("Genre", genre), ("Year", year), ("Director", director), ("Plot", plot)]
    return F.concat_ws(" | ", *[F.concat(F.lit(f"{label}: "), blank(c)) for label, c in labelled])


def estimate_tokens(c: Column) -> Column:
    return (F.floor(F.length(c) / 4) + 1).cast("long")


def count_words_tokens(prompt: Column, response: Column) -> Column:
    return (F.size(words(prompt)) + F.size(words(response))).cast("long")


def truncate_ellipsis(c: Column, limit: int | Column) -> Column:
    limit = F.lit(limit) if isinstance(limit, int) else limit
    return F.when(F.length(c) > limit, F.concat(F.substring(c, F.lit(1), limit - 3), F.lit("..."))).otherwise(c)


def first_line(c: Column) -> Column:
    return F.split_part(c, F.lit("\n"), F.lit(1))


def rationale_line(c: Column, limit: int = 100) -> Column:
    """One line, at most ``limit`` characters."""
    return truncate_ellipsis(first_line(F.btrim(c, F.lit(" \t\r\n"))), limit)


def query_preview(c: Column, limit: int = 100) -> Column:
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit("..."))).otherwise(c)


def _strip(c: Column) -> Column:
    return F.btrim(c, F.lit(" \t\r\n\x0b\x0c"))


def parse_summary_sentiment(c: Column) -> Column:
    """struct<summary, sentiment> out of a ``SUMMARY: … SENTIMENT: …`` reply."""
    found = F.contains(c, F.lit("SUMMARY:"))
    pieces = F.split(c, "SENTIMENT:")
    summary = _strip(F.replace(pieces[0], F.lit("SUMMARY:"), F.lit("")))
    sentiment = F.when(F.size(pieces) > 1, F.lower(_strip(F.get(pieces, F.lit(1)))))
    return F.struct(
        F.when(found, summary).otherwise(F.lit("Review summary not available.")).alias("summary"),
        F.coalesce(F.when(found, sentiment), F.lit("neutral")).alias("sentiment"),
    )


def strip_fences(c: Column) -> Column:
    body = F.regexp_replace(_strip(c), r"\A```json", "")
    body = F.regexp_replace(body, r"\A```", "")
    return _strip(F.regexp_replace(body, r"```\z", ""))


def parse_json_response(c: Column, schema: str) -> Column:
    """Fenced JSON text -> struct; null when it does not parse."""
    return F.from_json(strip_fences(c), schema, {"mode": "PERMISSIVE"})


def jaccard_words(a: Column, b: Column) -> Column:
    def ratio(left: Column, right: Column) -> Column:
        empty = (F.size(left) == 0) | (F.size(right) == 0)
        shared, union = F.size(F.array_intersect(left, right)), F.size(F.array_union(left, right))
        return F.when(empty, F.lit(0.0)).otherwise(shared / union)

    return let_all(ratio, left=word_set(a), right=word_set(b))


def keyword_score(query: Column, text: Column) -> Column:
    """Share of distinct query terms found as substrings of ``text`` (lower-cased)."""
    return let_all(
        lambda terms, text: F.size(F.filter(terms, lambda t: F.contains(text, t))) / F.greatest(F.size(terms), F.lit(1)),
        terms=word_set(query),
        text=text,
    )


def default_prompt(query: Column, context: Column) -> Column:
    """``- title (year): plot[:200]`` lines between a fixed frame; ``context`` is an array of structs."""
    lines = F.transform(
        context,
        lambda d: F.concat(
            F.lit("- "), blank(d["title"]), F.lit(" ("), blank(d["year"]), F.lit("): "), F.substring(blank(d["plot"]), 1, 200)
        ),
    )
    return F.concat(
        F.lit("Answer the question from the items listed below.\n\n"),
        F.array_join(lines, "\n"),
        F.lit("\n\nQuestion: "),
        query,
        F.lit("\n\nBe brief and cite items from the list."),
    )
