"""What several operators share: tables, held-out rows, columns picked by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagedater.session import stage

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(key: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the key as text leaves the remainder; a null key is never held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(modulus)) == remainder, F.lit(False))


def learnable(key: str, modulus: int, remainder: int) -> Column:
    """Whether a row may be learned from; a null key is never learned from."""
    return F.col(key).isNotNull() & ~held_out(key, modulus, remainder)


def picked(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that no other column can clash with working names."""
    return df.select(*(df[name] for name in names))


def least_hashes(ranked: DataFrame, most: int) -> DataFrame:
    """The rows with the ``most`` smallest values of ``hash``."""
    return ranked.orderBy("hash").limit(most)


def smallest_hashes(df: DataFrame, label: str, key: Column, most: int) -> DataFrame:
    """A bounded sample: the rows of each label with the ``most`` smallest hashes of ``key``.

    Hashes are sorted label by label, where each task passes on its ``most`` smallest only;
    the rows themselves are read once more and filtered by the last hash of their label, so
    no row of the sample is shuffled. Labels must be few.
    """
    ranked = stage(df.select(F.col(label).alias("label"), F.xxhash64(key).alias("hash")), "hashes")
    last = []
    for row in ranked.select("label").distinct().collect():
        first = least_hashes(ranked.filter(F.col("label").eqNullSafe(F.lit(row["label"]))), most)
        last += first.groupBy("label").agg(F.max("hash").alias("last")).collect()
    wanted = F.lit(False)
    for row in last:
        wanted = wanted | ((F.col(label) == F.lit(row["label"])) & (F.xxhash64(key) <= F.lit(row["last"])))
    # Rows that share a hash with the last one would exceed the bound.
    return df.filter(wanted).limit(most * max(1, len(last)))
