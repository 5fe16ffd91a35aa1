"""Column tables in, and parquet, CSV and JSON out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(path)


def spread(df: DataFrame, key: str, source: DataFrame | None = None) -> DataFrame:
    """Put rows from a scan of fewer splits than cores on all cores, by a unique key.

    One small file is one task, however dear the work on its texts. A scan that
    already has a split per core stays as it is: at scale nothing is shuffled here.
    ``source`` is the scan that ``df`` was made from, when it is not one itself.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    scan = df if source is None else source
    return df.repartition(cores, key) if scan.rdd.getNumPartitions() < cores else df


def write_table(
    df: DataFrame, path: str, partition_by: str | None = None, mode: str = "errorifexists"
) -> None:
    """Parquet, zstd. ``partition_by='split'`` gives one folder per split."""
    writer = df.write.mode(mode)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path, compression="zstd")


# White space belongs to the text, and quotes are doubled inside quoted fields.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header, as a folder of parts."""
    df.write.mode(mode).csv(path, **CSV_OPTIONS)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read what ``write_csv`` wrote: fields may hold line breaks, empty is not NULL."""
    return spark.read.csv(path, schema=schema, multiLine=True, nullValue="\x01", **CSV_OPTIONS)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines; lists stay lists."""
    df.write.mode(mode).json(path)
