"""Session helpers: building a local session, staging tables, checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Largest side that is ever hinted for broadcast. Both are checked at run time.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


def local_session(cpus: int | str = "*", app: str = "pagedater") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    partitions = "8" if cpus == "*" else str(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables.

    A cluster names it in ``spark.checkpoint.dir``; without it this is an error there.
    Only on one machine (tests) a fresh temporary folder is made for the session.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pagedater-"))
        root = spark.sparkContext.getCheckpointDir()
    return root


def staging_path(spark: SparkSession, name: str) -> str:
    return f"{staging_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage", schema: StructType | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing the
    regex work), and, unlike a checkpoint, keeps the columns prunable. ``schema`` reads
    a column by another name for its type, such as a struct as the vector it stands for.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(schema or df.schema).parquet(path)


def fits_broadcast(staged: DataFrame) -> bool:
    """Whether a staged table is within the bounds of a broadcast, in rows and bytes."""
    size = (
        staged.limit(BROADCAST_ROWS + 1)
        .agg(
            F.count("*").alias("rows"),
            F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("bytes"),
        )
        .first()
    )
    return size["rows"] <= BROADCAST_ROWS and (size["bytes"] or 0) <= BROADCAST_BYTES


def broadcast_if_small(staged: DataFrame) -> DataFrame:
    """Hint a staged table for broadcast when it fits.

    Above the bounds the table comes back without a hint and the join shuffles.
    """
    return F.broadcast(staged) if fits_broadcast(staged) else staged
