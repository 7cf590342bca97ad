"""Index, model, report and metric stores on plain Parquet / JSON."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid import schemas
from tastegrid.operators import retrieval
from tastegrid.operators.factors import Factors
from tastegrid.session import ensure_checkpoint_dir, spread
from tastegrid.sources.readers import load_documents_csv, load_documents_json


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ---- versions: a store is a folder of versions and a manifest that names the one in force ----
def _commit(spark: SparkSession, path: str, version: str, parts: Sequence[str]) -> None:
    """Puts a whole version in force. The manifest is written last, as one row in a new folder.

    The newest complete manifest counts, so a writer that dies before this point leaves the version before it in force.
    Versions older than the one that was in force until now are removed: a reader of that one can finish.
    """
    before = _versions(spark, path)
    order = (before[0]["number"] if before else 0) + 1
    row = spark.range(1).select(F.lit(version).alias("version"), F.lit(order).cast("long").alias("number"), F.array(*map(F.lit, parts)).alias("parts"))
    row.coalesce(1).write.parquet(f"{path}/manifests/{order:012d}-{version}")
    for old in before[1:]:
        _remove(spark, f"{path}/{old['version']}")
        _remove(spark, f"{path}/manifests/{old['number']:012d}-{old['version']}")


def _versions(spark: SparkSession, path: str) -> list:
    """Manifest rows, newest first; there are two or three."""
    try:
        found = spark.read.schema("version string, number long, parts array<string>").parquet(f"{path}/manifests/*")
        return found.orderBy(F.desc("number"), F.desc("version")).collect()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return []
        raise


def _in_force(spark: SparkSession, path: str) -> str | None:
    """Folder of the version in force, None where there is none."""
    found = _versions(spark, path)
    return f"{path}/{found[0]['version']}" if found else None


def _remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whatever file system it is."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


# ---- vector index ----
def save_index(indexed: DataFrame, centroids: DataFrame, path: str) -> None:
    """Documents with vectors, one folder per cell, and the cell centres, as a new version that counts once it is whole."""
    spark, version = indexed.sparkSession, f"v-{uuid.uuid4().hex}"
    indexed.write.partitionBy("centroid").parquet(f"{path}/{version}/documents")
    centroids.write.parquet(f"{path}/{version}/centroids")
    _commit(spark, path, version, ["documents", "centroids"])


def load_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame] | None:
    """(documents, centroids) of the version in force, None where there is no index. A filter on ``centroid`` prunes folders."""
    folder = _in_force(spark, path)
    if folder is None:
        return None
    try:
        return spark.read.parquet(f"{folder}/documents"), spark.read.parquet(f"{folder}/centroids")
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e):  # an index of no documents
            return None
        raise


def ingest(spark: SparkSession, source: str | DataFrame, source_type: str, index_path: str, model: str = "digest", cells: int = 1) -> int:
    """Read, embed, place into cells, store; gives the number of documents."""
    if isinstance(source, DataFrame):
        docs = source
    elif source_type == "csv":
        docs = load_documents_csv(spark, source)
    elif source_type == "json":
        docs = load_documents_json(spark, source)
    else:
        raise ValueError(f"unknown source type: {source_type}")
    # a quoted file with line breaks is read by one task; the embedding is not left to it
    embedded = retrieval.embed_text(spread(docs, "id"), "content", model)
    save_index(*retrieval.ivf_build(embedded, cells), index_path)
    return load_index(spark, index_path)[0].count()


def is_ready(spark: SparkSession, path: str) -> bool:
    """An index with at least one document."""
    found = load_index(spark, path)
    return found is not None and not found[0].isEmpty()


def rebuild_index(spark: SparkSession, items_csv: str, path: str, cells: int = 1) -> int:
    return ingest(spark, items_csv, "csv", path, cells=cells)


def ensure_index(spark: SparkSession, path: str, items_csv: str, cells: int = 1) -> tuple[DataFrame, DataFrame]:
    """The stored index; rebuilt from the items file where it is missing or empty."""
    if not is_ready(spark, path):
        rebuild_index(spark, items_csv, path, cells)
    return load_index(spark, path)


# ---- recommender model ----
def save_model(model: Factors, path: str, version: str, **metadata) -> None:
    """Factors and metadata as a new version of the store that counts once it is whole."""
    spark, folder = model.user_factors.sparkSession, f"v-{uuid.uuid4().hex}"
    model.user_factors.write.parquet(f"{path}/{folder}/user_factors")
    model.item_factors.write.parquet(f"{path}/{folder}/item_factors")
    row = [(version, [float(s) for s in model.singular_values], {k: str(v) for k, v in metadata.items()})]
    schema = "version string, singular_values array<double>, metadata map<string,string>"
    spark.createDataFrame(row, schema).write.parquet(f"{path}/{folder}/metadata")
    _commit(spark, path, folder, ["user_factors", "item_factors", "metadata"])


def load_model(spark: SparkSession, paths: Sequence[str], required: bool = False) -> tuple[Factors, dict] | None:
    """The first place that holds a whole model; None (or an error where required) without one."""
    for path in paths:
        folder = _in_force(spark, path)
        if folder is None:
            continue
        meta = spark.read.parquet(f"{folder}/metadata").first()
        users, items = (spark.read.parquet(f"{folder}/{n}") for n in ("user_factors", "item_factors"))
        return Factors(users, items, meta["singular_values"]), {"version": meta["version"], **meta["metadata"]}
    if required:
        raise FileNotFoundError(f"no model in {list(paths)}")
    return None


# ---- reports ----
def write_experiment_results(summary: DataFrame, comparison: DataFrame, num_samples: int, path: str) -> str:
    """Summary and comparison as JSON tables plus a Markdown report; a handful of rows per table."""
    spark = summary.sparkSession
    stamped = F.lit(datetime.now(timezone.utc).isoformat())
    summary.withColumn("timestamp", stamped).coalesce(1).write.mode("overwrite").json(f"{path}/summaries")
    comparison.withColumn("num_samples", F.lit(num_samples)).coalesce(1).write.mode("overwrite").json(f"{path}/comparison")
    best = comparison.first().asDict()
    rows = [r.asDict() for r in summary.orderBy("ordinal").collect()]  # one row per strategy
    lines = ["# Prompt strategies", "", f"Samples: {num_samples}", "", "## Winners", ""]
    lines += [f"- {k.replace('_', ' ')}: {v}" for k, v in best.items()]
    lines += ["", "## Figures", "", "| Strategy | ROUGE-L F1 | Similarity | Factuality | Helpfulness | Latency (ms) | Error rate |", "|---|---|---|---|---|---|---|"]
    lines += [
        f"| {r['strategy']} | {r['rouge_l_f1']:.4f} | {r['embedding_similarity']:.4f} | {r['factuality']:.2f}/5 "
        f"| {r['helpfulness']:.2f}/5 | {r['latency_ms']:.0f} | {r['error_rate']:.1%} |"
        for r in rows
    ]
    k3, k5 = (next((r for r in rows if r["strategy"] == f"few_shot_k{k}"), None) for k in (3, 5))
    if k3 and k5:
        verdict = "more examples helped" if k5["rouge_l_f1"] > k3["rouge_l_f1"] else "more examples did not help"
        lines += ["", "## Three against five examples", "", f"ROUGE-L {k3['rouge_l_f1']:.4f} / {k5['rouge_l_f1']:.4f}: {verdict}"]
    text = "\n".join(lines) + "\n"
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/report")
    return text


def write_drift_report(per_column: DataFrame, dataset: DataFrame, path: str) -> None:
    """Per-column scores and the dataset verdict as JSON."""
    per_column.write.mode("overwrite").json(f"{path}/columns")
    dataset.coalesce(1).write.mode("overwrite").json(f"{path}/dataset")


# ---- operational sinks ----
def append_metric(metrics: DataFrame, path: str) -> None:
    """Append (name, value, unit, dimensions, ts) rows, one folder per day."""
    typed = metrics.selectExpr(*[f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in _fields(metrics, schemas.METRIC)])
    typed.withColumn("day", F.to_date("ts")).write.mode("append").partitionBy("day").parquet(path)


def append_log(lines: DataFrame, path: str) -> None:
    """Append (log_group, log_stream, message, ts) rows, one folder per day."""
    typed = lines.selectExpr(*[f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in _fields(lines, schemas.LOG_LINE)])
    typed.withColumn("day", F.to_date("ts")).write.mode("append").partitionBy("day").parquet(path)


def _fields(df: DataFrame, ddl: str) -> list:
    return df.sparkSession.createDataFrame([], ddl).schema.fields
