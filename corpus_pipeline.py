"""The corpus pipeline: stages over documents, each written as Parquet and reread as the next one's input.

quality classifier, n-gram Jaccard join, benchmark decontamination, mixing sources to target weights, sharding.
Every stage but the last returns the columns of documents; the last adds shard and slot.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegrid.llm import decontaminate, jaccard, mixing, quality, sharding
from tastegrid.llm.queries import ORACLE as OPERATOR_ORACLE
from tastegrid.llm.queries import QUERIES as OPERATOR_QUERIES
from tastegrid.session import ensure_checkpoint_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    model = quality.train(quality.with_features(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights: documents go, stay, repeat, or are cut at a block's end."""
    mixed = mixing.apply_mix(docs, mixing.mix_sources(docs))
    return mixed.withColumn("n_chars", F.length("text").cast("long"))  # a cut text has fewer


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row of the mix gets a shard and a slot."""
    return sharding.with_shards(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_leaks),
    ("mixing", mix),
    ("sharding", shard),
]

#: The classifier's scores and the components are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of ``sf_dir``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


QUERIES = {**OPERATOR_QUERIES, "pipeline": run}
ORACLE = {**OPERATOR_ORACLE, **({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})}
