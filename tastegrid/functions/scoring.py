"""Answer scoring expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tastegrid.functions.binding import let, let_all
from tastegrid.functions.text import blank, keyword_score, words

ROUGE = "struct<rouge_l_precision:double,rouge_l_recall:double,rouge_l_f1:double>"


def rouge_tokens(c: Column) -> Column:
    """Lower-case ASCII alphanumeric runs."""
    return F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda t: t != "")


def _rouge_struct(lcs: Column, n_pred: Column, n_ref: Column) -> Column:
    precision = F.when(n_pred > 0, lcs / n_pred).otherwise(F.lit(0.0))
    recall = F.when(n_ref > 0, lcs / n_ref).otherwise(F.lit(0.0))
    f1 = F.when(lcs > 0, 2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0))
    return F.struct(
        precision.cast("double").alias("rouge_l_precision"),
        recall.cast("double").alias("rouge_l_recall"),
        f1.cast("double").alias("rouge_l_f1"),
    )


def _lcs_length(a: np.ndarray, b: np.ndarray) -> int:
    """Longest common subsequence length, one vector row per token of ``a``.

    row[j] = max(up[j], best diagonal match so far) is a running maximum, so the inner loop is numpy.
    """
    row = np.zeros(len(b) + 1, dtype=np.int64)
    for token in a:
        step = np.where(b == token, row[:-1] + 1, row[1:])
        row[1:] = np.maximum.accumulate(step)
    return int(row[-1])


@F.pandas_udf(LongType())
def lcs_tokens(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for left, right in batches:
        out = []
        for a, b in zip(left, right):
            if a is None or b is None or len(a) == 0 or len(b) == 0:
                out.append(0)
                continue
            codes = {}
            x = np.fromiter((codes.setdefault(t, len(codes)) for t in a), dtype=np.int64, count=len(a))
            y = np.fromiter((codes.setdefault(t, len(codes)) for t in b), dtype=np.int64, count=len(b))
            out.append(_lcs_length(x, y) if len(x) <= len(y) else _lcs_length(y, x))
        yield pd.Series(out, dtype="int64")


def rouge_l(prediction: Column, reference: Column, stem=None) -> Column:
    """ROUGE-L precision, recall, F1. ``stem`` is an optional array->array expression (off by default)."""
    pred, ref = rouge_tokens(prediction), rouge_tokens(reference)
    if stem is not None:
        pred, ref = stem(pred), stem(ref)
    return _rouge_struct(lcs_tokens(pred, ref), F.size(pred), F.size(ref))


def answer_facts(context: Column) -> Column:
    """Distinct title, director, year and genres of the context (empty strings are kept in the set)."""
    per_doc = F.transform(
        context,
        lambda d: F.concat(
            F.array(F.lower(blank(d["title"])), F.lower(blank(d["director"])), blank(d["year"])),
            F.transform(F.split(F.lower(blank(d["genre"])), r"\|"), lambda g: F.trim(g)),
        ),
    )
    return F.array_distinct(F.flatten(per_doc))


def factuality_score(response: Column, context: Column) -> Column:
    """1..5 from the share of context facts named in the response; 3 without context."""

    def coverage(facts: Column, text: Column) -> Column:
        hits = F.size(F.filter(facts, lambda f: (f != "") & F.contains(text, f)))
        return hits / F.greatest(F.size(facts), F.lit(1))

    def ladder(share: Column) -> Column:
        return (
            F.when(share >= 0.4, 5.0).when(share >= 0.3, 4.0).when(share >= 0.2, 3.0).when(share >= 0.1, 2.0).otherwise(1.0)
        )

    scored = let(let_all(coverage, facts=answer_facts(context), text=F.lower(response)), ladder)
    return F.when(context.isNull() | (F.size(context) == 0), F.lit(3.0)).otherwise(scored)


# fixed values: markers that raise the helpfulness score
STRUCTURE_MARKERS = ["1.", "•", "-", "**"]
CITATION_MARKERS = ["[Source", "based on", "according to"]


def _any_marker(text: Column, markers: list[str]) -> Column:
    return F.regexp_like(text, F.lit("|".join(re.escape(m) for m in markers)))


def helpfulness_score(response: Column, query: Column) -> Column:
    length = let(
        F.size(words(response)), lambda n: F.when((n >= 50) & (n <= 300), 0.5).when(n < 20, -1.0).otherwise(0.0)
    )
    share = keyword_score(query, F.lower(response))
    score = (
        F.lit(3.0)
        + length
        + F.when(_any_marker(response, STRUCTURE_MARKERS), 0.5).otherwise(0.0)
        + F.when(_any_marker(response, CITATION_MARKERS), 0.5).otherwise(0.0)
        + share
    )
    return F.least(F.lit(5.0), F.greatest(F.lit(1.0), score))


def relevance_score(factuality: Column, helpfulness: Column) -> Column:
    return (factuality + helpfulness) / 2
