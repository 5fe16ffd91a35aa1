"""Evaluation of a prediction table ``(key, label, prediction)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Classes of the published confusion matrices.
CONFUSION_LABELS = (1450, 1500, 1550, 1600, 1650, 1700, 1750, 1800, 1850, 1900, 1950, 2000)


def accuracy(predictions: DataFrame) -> DataFrame:
    hit = (F.col("label") == F.col("prediction")).cast("int")
    return predictions.agg(F.avg(hit).alias("accuracy"))


def confusion(predictions: DataFrame, labels: Sequence = CONFUSION_LABELS) -> DataFrame:
    """Counts with a row per true and a column per predicted class of a fixed list.

    Pairs outside the list are not counted; classes without a row show 0.
    """
    names = [str(label) for label in labels]
    counted = (
        predictions.filter(F.col("label").isin(*labels) & F.col("prediction").isin(*labels))
        .groupBy("label")
        .pivot("prediction", list(labels))
        .count()
    )
    wanted = predictions.sparkSession.createDataFrame(
        [(label,) for label in labels], predictions.select("label").schema
    )
    # At most one row per listed class on either side.
    return wanted.join(F.broadcast(counted), "label", "left").na.fill(0, subset=names)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def class_report(predictions: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted averages.

    Classes are those seen in truth or prediction; a ratio without a denominator is 0.
    The data is read once, into one row per (label, prediction).
    """
    cells = predictions.groupBy("label", "prediction").agg(F.count("*").alias("n"))

    def side(name: Column, actual: Column, predicted: Column) -> Column:
        hit = F.when((F.col("label") == F.col("prediction")) & (actual > 0), F.col("n"))
        return F.struct(
            name.cast("string").alias("class"),
            actual.alias("actual"),
            predicted.alias("predicted"),
            F.coalesce(hit, F.lit(0)).cast("bigint").alias("hits"),
        )

    none = F.lit(0).cast("bigint")
    sides = F.array(
        side(F.col("label"), F.col("n"), none), side(F.col("prediction"), none, F.col("n"))
    )
    sums = cells.select(F.inline(sides)).groupBy("class").agg(
        F.sum("actual").alias("support"),
        F.sum("predicted").alias("predicted"),
        F.sum("hits").alias("hits"),
    )
    rated = sums.select(
        "class",
        _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
    )
    figures = ["precision", "recall", "f1"]
    total = F.sum("support")
    macro = rated.agg(
        F.lit("macro avg").alias("class"),
        *[F.avg(c).alias(c) for c in figures],
        total.alias("support"),
    )
    weighted = rated.agg(
        F.lit("weighted avg").alias("class"),
        *[(F.sum(F.col(c) * F.col("support")) / total).alias(c) for c in figures],
        total.alias("support"),
    )
    return rated.unionByName(macro).unionByName(weighted)


def neighbour_error(predictions: DataFrame, width: int = 50) -> DataFrame:
    """Share of predictions at most one period away from the truth."""
    near = (F.abs(F.col("label") - F.col("prediction")) <= width).cast("int")
    return predictions.agg(F.avg(near).alias("near_share"))
