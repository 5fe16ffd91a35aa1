"""MediaWiki XML dumps as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# Fixed: the part of the export format that is read.
DUMP_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("ns", T.IntegerType()),
        T.StructField("id", T.LongType()),
        T.StructField("redirect", T.StructType([T.StructField("_title", T.StringType())])),
        T.StructField(
            "revision",
            T.StructType(
                [
                    T.StructField("id", T.LongType()),
                    T.StructField("model", T.StringType()),
                    T.StructField("format", T.StringType()),
                    T.StructField(
                        "text",
                        T.StructType(
                            [
                                T.StructField("_VALUE", T.StringType()),
                                T.StructField("_bytes", T.LongType()),
                            ]
                        ),
                    ),
                ]
            ),
        ),
    ]
)


def parsed_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per ``<page>``; what can't be read whole has its source in ``_corrupt_record``.

    The scan is cut at the end of each page (inside texts the mark is escaped) and each
    piece is parsed alone, so a damaged page harms no other. A page cut off by the end of
    the file is damaged too. Pieces without a page are the head and foot of the dump.
    """
    schema = T.StructType([*DUMP_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    pieces = spark.read.option("lineSep", "</page>").text(path)
    start = F.locate("<page", F.col("value"))
    pages = pieces.filter(start > 0).select(F.concat(F.col("value").substr(start, F.length("value")), F.lit("</page>")).alias("value"))
    options = {"ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    # Exploded, a page is parsed once: no filter on its fields is moved below, to parse it anew.
    page = F.explode(F.array(F.from_xml("value", schema, options)))
    return pages.select(page.alias("page"), "value").select(
        *[F.col("page")[f.name].alias(f.name) for f in DUMP_SCHEMA.fields],
        F.when(damaged(F.col("page")), F.col("value")).alias(CORRUPT),
    )


def damaged(page: Column) -> Column:
    """Whether a parsed page lacks what every page of a dump has."""
    return page.isNull() | page[CORRUPT].isNotNull() | page["id"].isNull() | page["revision"]["id"].isNull()


def read_dump(spark: SparkSession, path: str, damaged_pages: str = "error") -> DataFrame:
    """One row per ``<page>`` of a dump, plain or compressed (bz2 is split).

    A damaged page ends the job; with ``damaged_pages="drop"`` the others are read and
    ``rejected_pages`` has those left out.
    """
    if damaged_pages not in ("error", "drop"):
        raise ValueError(f"damaged_pages is 'error' or 'drop', not {damaged_pages!r}")
    rows, bad = parsed_pages(spark, path), F.col(CORRUPT).isNotNull()
    if damaged_pages == "error":
        start = F.concat(F.lit("damaged page: "), F.substring(CORRUPT, 1, 200))
        return rows.filter(F.when(bad, F.raise_error(start).cast("boolean")).otherwise(True)).drop(CORRUPT)
    return rows.filter(~bad).drop(CORRUPT)


def rejected_pages(spark: SparkSession, path: str) -> DataFrame:
    """Sources of the damaged pages of a dump, ``(title, source)``; the title as far as it can be read."""
    bad = parsed_pages(spark, path).filter(F.col(CORRUPT).isNotNull())
    title = F.regexp_extract(CORRUPT, "<title>([^<]*)</title>", 1)
    return bad.select(title.alias("title"), F.col(CORRUPT).alias("source"))


def write_dump(df: DataFrame, path: str, codec: str = "bzip2") -> None:
    """Write rows of ``DUMP_SCHEMA`` as XML (for fixtures and round trips)."""
    (
        df.write.format("xml")
        .option("rowTag", "page")
        .option("rootTag", "mediawiki")
        .option("compression", codec)
        .save(path)
    )
