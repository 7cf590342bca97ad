"""Row keys and word counts shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A word: a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def digest(text: Column) -> Column:
    """32 bytes that stand for a text; null stays null."""
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """Adds ``_digest`` and ``_copy``: with doc_id (and ``more``) they name each row, repeated rows included.

    Rows that agree in all of them are interchangeable, so numbering them in any order gives the same table.
    """
    return numbered(docs.withColumn("_digest", digest(F.col("text"))), *more)


def numbered(marked: DataFrame, *more: str) -> DataFrame:
    """``_copy`` for rows that have a ``_digest`` already: their texts need not travel."""
    same = Window.partitionBy("doc_id", "_digest", *more).orderBy(F.lit(0))
    return marked.withColumn("_copy", F.row_number().over(same))


def attach(docs: DataFrame, found: DataFrame, keys: list[str], take: list[str]) -> DataFrame:
    """``docs`` with the columns ``take`` of ``found``, joined null-safely on ``keys``."""
    named = found.select(*[F.col(k).alias(f"_j{i}") for i, k in enumerate(keys)], *take)
    on = F.lit(True)
    for i, k in enumerate(keys):
        on = on & docs[k].eqNullSafe(named[f"_j{i}"])
    return docs.join(named, on, "inner").drop(*[f"_j{i}" for i in range(len(keys))])
