"""Years, periods and lists as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
YEAR = "[1-2][0-9]{3}"
DECOY_PREFIX = "Domaine public en"
PERIOD_WIDTH = 50


def exclude_category_prefix(categories: Column, prefix: str = DECOY_PREFIX) -> Column:
    return F.filter(categories, lambda c: ~F.startswith(c, F.lit(prefix)))


def extract_years(categories: Column) -> Column:
    """All four-digit years of every category, in order, as integers."""
    found = F.transform(
        categories, lambda c: F.regexp_extract_all(c, F.lit(YEAR), F.lit(0))
    )
    return F.flatten(found).cast("array<int>")


def publication_year(categories: Column) -> Column:
    """Most recent year over all categories but the decoys; NULL when there is none."""
    return F.array_max(extract_years(exclude_category_prefix(categories)))


def period(year: Column, width: int = PERIOD_WIDTH) -> Column:
    """Start of the period of ``width`` years that holds ``year``."""
    return (year - F.pmod(year, F.lit(width))).cast("int")


def n_chars(text: Column) -> Column:
    return F.length(text).cast("bigint")


def join_list(values: Column, separator: str = ",") -> Column:
    return F.array_join(values, separator)


def merge_sets(own: Column, other: Column) -> Column:
    """Sorted union of two sets; a missing set counts as empty."""
    empty = F.array().cast("array<string>")
    return F.array_sort(F.array_union(F.coalesce(own, empty), F.coalesce(other, empty)))
