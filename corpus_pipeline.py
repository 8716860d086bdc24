"""A corpus pipeline: quality filter, near-duplicate removal, decontamination, mixing, token ids."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lumenfit.llm import decontaminate, mixing, ngram_join, quality, token_store
from lumenfit.llm.common import table
from lumenfit.llm.queries import quality_model, tokenizer_path
from lumenfit.session import shared_folder


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention model scores 0.3 or more."""
    return quality.accepted(docs, quality_model(spark, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles of five words at a similarity of 0.8."""
    return ngram_join.deduplicated(docs, k=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of ten words of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the balanced mix of sources takes it, up to three times."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token store of the mix, read back: a row per record."""
    return token_store.read(docs, token_store.write(docs, tokenizer_path()), ids=False)


STAGES = [("quality", quality_filter), ("near_duplicates", near_duplicates), ("decontamination", decontaminated), ("mixing", mix), ("token_ids", token_ids)]

# The model of the first stage and the hashes of the fourth have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's result is a table that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
