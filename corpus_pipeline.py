"""From documents to packed sequences: five stages over everything the one before kept.

Quality classifier, SimHash near-dedup, benchmark decontamination, secret scan, packing.
Each stage's result is written as Parquet and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagedater.llm import decontaminate, packing, quality, secrets, simhash
from pagedater.llm.common import DOCUMENT_COLUMNS, table
from pagedater.session import staging_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; null and empty texts are scored like others."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels")).select(*DOCUMENT_COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that links of four-word fingerprints join the document with the smallest id stays.

    Null, empty and blank texts have one fingerprint and are one group; a null id stays only
    where its group has no other.
    """
    return simhash.one_of_each(docs, shingle=4).select(*DOCUMENT_COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go; null and empty texts have none and stay."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark")).select(*DOCUMENT_COLUMNS)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are blanked out; every document stays, with its length counted anew, null if the text is."""
    redacted = secrets.redact(docs.select(*DOCUMENT_COLUMNS))
    return redacted.withColumn("n_chars", F.length("text").cast("long"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences: a row per piece; null and empty texts are their end id only."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

#: Compression and subword ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = staging_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
