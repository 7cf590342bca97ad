"""Line dedup by distinct-site spread, in DataFrame operations only.

A line is boilerplate if it stands on at least ``min_sites`` distinct sites (sources). HyperLogLog sketches
of the sites are built per line hash before the shuffle and merged by aggregation; lines whose estimate is
near the threshold get an exact distinct count, so the decision is exact as long as the sketch errs by less
than the band. A line that a third of all documents share is one sketch per task, never a list.

Nulls, ties and odd rows: a null text has no lines and stays null; blank lines are never boilerplate; a null
source is no site; lines are compared without leading and trailing spaces; repeated rows get equal results;
an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegrid.llm.layout import digest
from tastegrid.session import settle

#: Sites that make a line boilerplate; 2**LOG_K sketch registers (2.3 % error); the band is 4 errors wide, 2 sites at least.
MIN_SITES, LOG_K, BAND = 10, 11, 0.1


def exploded_lines(docs: DataFrame) -> DataFrame:
    """doc_id, _digest, source, at, h1, h2: one row per line that is not blank, named by 128 hash bits."""
    rows = docs.where(F.col("text").isNotNull()).select(
        "doc_id", "source", digest(F.col("text")).alias("_digest"), F.posexplode(F.split("text", "\n")).alias("at", "_line")
    )
    line = F.trim(F.col("_line"))
    return rows.where(line != "").select(
        "doc_id", "_digest", "source", "at", F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2")
    )


def boilerplate_lines(lines: DataFrame, min_sites: int = MIN_SITES, log_k: int = LOG_K, band: float = BAND) -> DataFrame:
    """h1, h2 of the lines that stand on at least ``min_sites`` sites."""
    width = max(2, round(band * min_sites))
    # written out: the joins below then read plain tables, whose hot keys Spark splits, and nothing is counted twice
    spread = settle(
        lines.where(F.col("source").isNotNull())
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("_n"), F.hll_sketch_agg("source", F.lit(log_k)).alias("_s"))
        .where(F.col("_n") >= min_sites)
        .select("h1", "h2", F.hll_sketch_estimate("_s").alias("_sites"))
        .where(F.col("_sites") >= min_sites - width)
    )
    sure = spread.where(F.col("_sites") > min_sites + width).select("h1", "h2")
    near = spread.where(F.col("_sites") <= min_sites + width).select("h1", "h2")
    exact = settle(
        lines.where(F.col("source").isNotNull())
        .join(near, ["h1", "h2"], "left_semi")
        .groupBy("h1", "h2", "source")
        .agg(F.lit(1).alias("_one"))
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("_sites"))
        .where(F.col("_sites") >= min_sites)
        .select("h1", "h2")
    )
    return sure.unionByName(exact)


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, log_k: int = LOG_K, band: float = BAND) -> DataFrame:
    """``docs`` with ``text`` cleaned, ``n_lines`` and ``n_removed``; the other columns as they came."""
    lines = exploded_lines(docs)
    bad = boilerplate_lines(lines, min_sites, log_k, band)
    drops = (
        lines.join(bad, ["h1", "h2"], "left_semi")
        .groupBy("doc_id", "_digest")
        .agg(F.collect_set("at").alias("_drop"))
        .select(F.col("doc_id").alias("_id"), F.col("_digest").alias("_d"), "_drop")
    )
    # the helper columns go into one struct, so that they clash with no column of the table
    rows = docs.withColumn("_row_digest", digest(F.col("text")))
    on = rows["doc_id"].eqNullSafe(drops["_id"]) & (rows["_row_digest"] == drops["_d"])
    both = rows.join(drops, on, "left")
    parts = F.split("text", "\n")
    kept = F.filter(parts, lambda x, i: ~F.array_contains("_drop", i))
    n_removed = F.when(F.col("text").isNotNull(), F.coalesce(F.size("_drop"), F.lit(0))).otherwise(0)
    out = [F.when(F.col("_drop").isNotNull(), F.array_join(kept, "\n")).otherwise(F.col("text")).alias("text") if c == "text" else rows[c] for c in docs.columns if c not in ("n_lines", "n_removed")]
    return both.select(
        *out, F.when(F.col("text").isNotNull(), F.size(parts)).otherwise(0).cast("long").alias("n_lines"), n_removed.cast("long").alias("n_removed")
    )
