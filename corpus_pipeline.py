"""The corpus pipeline: toxic documents, copies, near copies and benchmark passages go, the rest is packed.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the
last return the columns of documents; the last returns pieces of token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartlens.llm import decontaminate, exact_dedup, packing, simhash, toxicity
from cartlens.llm.common import prepare
from cartlens.llm.queries import toxicity_model
from cartlens.llm.tokens import vocabulary_path
from cartlens.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator rejects go; the model is fitted on this stage's labelled rows."""
    prepare(spark)
    return toxicity.keep_clean(docs, toxicity_model(spark, docs, sf_dir))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest doc_id stays."""
    prepare(spark)
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group, the document with the smallest doc_id stays."""
    prepare(spark)
    return simhash.deduplicate(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark items go."""
    return decontaminate.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two length, with a checksum of their ids."""
    prepare(spark)
    return packing.piece_digests(packing.decompose(docs, vocabulary_path()))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic),
    ("exact_dedup", exact),
    ("simhash_dedup", near),
    ("decontamination", clean_of_benchmark),
    ("packing", packed),
]

# Toxicity models, connected components and token ids have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
