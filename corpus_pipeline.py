"""From documents to shards: quality, near copies, benchmark passages, source mix, sharding.

Every stage takes what the one before kept, written as Parquet in the shared folder and read
again, so a lost executor costs a task and not the stages before.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import decontam, mixing, quality, sharding, sigtree
from lectern.llm.base import prepare, table
from lectern.session import shared_folder


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules hold to be good."""
    prepare(spark)
    return quality.keep_good(docs)


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group linked by shingles."""
    prepare(spark)
    return sigtree.keep_first(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    prepare(spark)
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    prepare(spark)
    return mixing.mix_sources(docs, whole_rows=True)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of each row."""
    prepare(spark)
    return sharding.assign(docs)


STAGES = [
    ("quality rules", keep_good),
    ("near copies", keep_first),
    ("benchmark decontamination", keep_clean),
    ("source mix", mix),
    ("shards", shard),
]

#: Expectation-maximisation has no SQL form; tests/llm tests the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/pipeline-{name.replace(' ', '-')}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
