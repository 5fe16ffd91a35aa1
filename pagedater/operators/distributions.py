"""Counts per category, year and class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbering import sorted_parts

QUARTILES = (25, 50, 75)


def category_distribution(df: DataFrame) -> DataFrame:
    """Pages per category; pages without any are counted under NULL."""
    exploded = df.select(F.explode_outer("categories").alias("category"))
    return exploded.groupBy("category").agg(F.count("*").alias("pages"))


def distinct_categories(df: DataFrame) -> DataFrame:
    return df.select(F.explode_outer("categories").alias("category")).distinct()


def distinct_category_lists(df: DataFrame) -> DataFrame:
    return df.select(F.array_sort("categories").alias("categories")).distinct()


def distinct_category_strings(df: DataFrame, separator: str = ",") -> DataFrame:
    joined = F.array_join(F.array_sort("categories"), separator)
    return df.select(joined.alias("categories")).distinct()


def _characters(df: DataFrame) -> Column:
    """Characters per row; a stored count saves reading the text."""
    return F.col("n_chars") if "n_chars" in df.columns else F.length("text").cast("bigint")


def _distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(
        F.count("*").alias("pages"), F.sum(_characters(df)).alias("characters")
    )


def year_distribution(df: DataFrame) -> DataFrame:
    """Pages and characters per publication year."""
    return _distribution(df, "pubyear")


def class_distribution(df: DataFrame) -> DataFrame:
    """Pages and characters per period class."""
    return _distribution(df, "semicentury")


def quantiles(df: DataFrame, shares: Sequence[float], *columns: str) -> DataFrame:
    """``(column, q0, q1, ...)``: the value at each share of a column's rows, exact; nulls are left out.

    Counts per distinct value are range-partitioned by value. The counts of the parts tell
    which part holds each quantile, and only those parts add up their rows in order, so
    memory follows a part, not the column.
    """
    values = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]))
    ).filter("value is not null")
    counts = values.groupBy("column", "value").agg(F.count("*").alias("n"))
    ordered = sorted_parts(counts, "column", "value").withColumn("part", F.shiftright("_at", 33)).drop("_at")
    parts = ordered.groupBy("column", "part").agg(F.sum("n").alias("here"))
    # As many rows to a column as there are parts.
    column = Window.partitionBy("column")
    before = column.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sized = parts.withColumns(
        {"before": F.coalesce(F.sum("here").over(before), F.lit(0)), "size": F.sum("here").over(column)}
    )
    ranks = [
        F.struct(F.lit(i).alias("q"), F.greatest(F.ceil(F.col("size") * F.lit(float(q))), F.lit(1)).alias("rank"))
        for i, q in enumerate(shares)
    ]
    wanted = sized.withColumn("want", F.explode(F.array(*ranks))).filter(
        (F.col("want.rank") > F.col("before")) & (F.col("want.rank") <= F.col("before") + F.col("here"))
    )
    # A row per column and share.
    wanted = wanted.select("column", "part", "want.q", (F.col("want.rank") - F.col("before")).alias("rank"))
    upto = Window.partitionBy("column", "part", "q").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    inside = ordered.join(F.broadcast(wanted), ["column", "part"]).withColumn("upto", F.sum("n").over(upto))
    found = inside.filter(F.col("upto") >= F.col("rank")).groupBy("column", "q").agg(F.min("value").alias("value"))
    return found.groupBy("column").agg(
        *[F.max(F.when(F.col("q") == i, F.col("value"))).alias(f"q{i}") for i in range(len(shares))]
    )


def describe(df: DataFrame, *columns: str) -> DataFrame:
    """One row of summary figures per numeric column; quartiles are values of the column."""
    figures = []
    for name in columns:
        c = F.col(name)
        figures.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count(c).alias("count"),
                F.count_if(c.isNull()).alias("nulls"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(name)
        )
    rows = df.agg(*figures).select(F.inline(F.array(*[F.col(f"`{name}`") for name in columns])))
    located = quantiles(df, [q / 100 for q in QUARTILES], *columns)
    named = located.select("column", *[F.col(f"q{i}").alias(f"q{q}") for i, q in enumerate(QUARTILES)])
    return rows.join(F.broadcast(named), "column", "left").select(
        "column", "count", "nulls", "mean", "std", "min", *[f"q{q}" for q in QUARTILES], "max"
    )


def describe_text(df: DataFrame, *columns: str) -> DataFrame:
    """One row per text column: counts, distinct values, first and last value, lengths.

    Distinct values are counted by a shuffle on the value, column by column.
    """
    out = None
    for name in columns:
        c = F.col(name)
        values = df.groupBy(c.alias("value")).agg(F.count("*").alias("n"))
        row = values.agg(
            F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("count"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.count("value").alias("distinct"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.min(F.length("value")).alias("shortest"),
            F.max(F.length("value")).alias("longest"),
        ).select(F.lit(name).alias("column"), "*")
        out = row if out is None else out.unionByName(row)
    return out
