"""From raw documents to token files: five stages, each over all that the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumenframe.llm import decontaminate, fertility, mixing, simhash, tokenfiles
from lumenframe.llm.queries import MIX_SHARE, MIX_WEIGHTS
from lumenframe.session import work_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return fertility.good_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed_documents(docs, MIX_WEIGHTS, MIX_SHARE)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token ids; a row for each document in the files, read back from them."""
    folder = work_dir(spark, "tokens")
    tokenfiles.write_tokens(docs, folder)
    return tokenfiles.checked_tokens(spark, folder)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", token_output),
]

#: SQL has neither the vocabularies nor the latent search; tests compare stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what a stage returns is written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        folder = work_dir(spark, f"stage-{n}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
