"""Publication years and period classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import years as yr
from .pages import drop_null_label


def publication_year(df: DataFrame) -> DataFrame:
    """Add ``pubyear``, the most recent year of a page's categories (or NULL)."""
    return df.withColumn("pubyear", yr.publication_year(F.col("categories")))


def period_label(
    df: DataFrame, width: int = yr.PERIOD_WIDTH, year: str = "pubyear", label: str = "semicentury"
) -> DataFrame:
    """Add the start of the period a year falls into."""
    return df.withColumn(label, yr.period(F.col(year), width))


def clean_pages(df: DataFrame) -> DataFrame:
    """Raw pages to dated pages: the categories give way to ``pubyear``."""
    dated = drop_null_label(publication_year(df), "pubyear")
    kept = [c for c in ("page_id", "title", "pubyear", "quality", "n_chars", "text") if c in dated.columns]
    return dated.select(*kept)


def labelled_pages(df: DataFrame, width: int = yr.PERIOD_WIDTH) -> DataFrame:
    return period_label(clean_pages(df), width)
