"""Readers with fixed schemas and an ordered list of places to look."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tastegrid import schemas
from tastegrid.functions.text import doc_content


def _first_readable(paths: Sequence[str], read: Callable[[str], DataFrame]) -> DataFrame | None:
    """The first path that exists; Spark checks existence when the plan is analysed."""
    for path in paths:
        try:
            return read(path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    return None


def _paths(path: str | Sequence[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def load_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType, line_per_row: bool = False) -> DataFrame:
    """CSV with a header; columns are matched to the schema by name, missing ones are null.

    ``path`` may be any URI Spark can reach; a list is tried in order. Nothing found is an error. Quoted fields
    may hold line breaks, so a file is one task: write many files. ``line_per_row`` promises that no field has
    a line break; files are then split.
    """

    def read(p: str) -> DataFrame:
        options = {"header": True, "quote": '"', "escape": '"', "multiLine": not line_per_row}
        names = spark.read.options(**options).csv(p).columns  # header line only
        # columns are read as text and cast, so the order in the file does not matter
        text = spark.read.options(**options).schema(", ".join(f"`{n}` string" for n in names)).csv(p)
        fields = [
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
        return text.select(*fields)

    found = _first_readable(_paths(path), read)
    if found is None:
        raise FileNotFoundError(f"none of {_paths(path)} exists")
    return found


def read_items(spark: SparkSession, primary: str, fallback: str | None = None) -> DataFrame:
    """Items table: the primary place, else the fallback."""
    return load_csv(spark, [p for p in (primary, fallback) if p], schemas.ITEMS)


def read_ratings(spark: SparkSession, primary: str, fallback: str | None = None) -> DataFrame:
    """Ratings table: the primary place, else the fallback."""
    return load_csv(spark, [p for p in (primary, fallback) if p], schemas.RATINGS)


def _blank_defaults(df: DataFrame) -> DataFrame:
    """Missing year and rating count as 0, missing text as ''."""
    fills = {c: F.coalesce(F.col(c), F.lit("")) for c in ("title", "genre", "director", "cast", "plot")}
    fills |= {"year": F.coalesce("year", F.lit(0)), "rating": F.coalesce("rating", F.lit(0.0))}
    return df.withColumns(fills)


def load_documents_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """CSV items to documents with searchable content and a metadata map."""
    items = load_csv(spark, path, schemas.ITEMS)
    content = doc_content(*[F.col(c) for c in ("title", "genre", "year", "director", "plot")])
    extra = ["budget", "revenue", "runtime", "popularity"]
    metadata = F.create_map(*[x for c in extra for x in (F.lit(c), F.col(c).cast("string"))])
    docs = items.withColumn("content", content).withColumn("metadata", metadata)
    return _blank_defaults(docs).select(*schemas.DOCUMENT.names)


def load_documents_json(spark: SparkSession, path: str | Sequence[str], lines: bool = False) -> DataFrame:
    """A JSON array per file, or JSON lines (``lines``, which split across tasks), to documents."""
    found = _first_readable(
        _paths(path), lambda p: spark.read.schema(schemas.DOCUMENT).option("multiLine", not lines).json(p)
    )
    if found is None:
        raise FileNotFoundError(f"none of {_paths(path)} exists")
    empty = F.create_map().cast("map<string,string>")
    return _blank_defaults(found).withColumns(
        {
            "id": F.coalesce("id", F.lit("")),
            "content": F.coalesce("content", F.lit("")),
            "metadata": F.coalesce("metadata", empty),
        }
    )


def read_eval_jsonl(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """JSON lines of id, query, reference, category; blank lines are skipped, a missing file is empty."""
    found = _first_readable(_paths(path), lambda p: spark.read.schema(schemas.EVAL).json(p))
    if found is None:
        return spark.createDataFrame([], schemas.EVAL)
    return found.where(F.col("id").isNotNull() | F.col("query").isNotNull())
