"""From the raw page table to labelled pages, splits and distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import distributions, labels, splits
from . import extraction


def labelled(raw: DataFrame) -> DataFrame:
    return labels.labelled_pages(raw)


def class_distribution(pages: DataFrame) -> DataFrame:
    """Pages and characters per period class, straight from a table of wiki pages."""
    return distributions.class_distribution(labels.period_label(extraction.dated(pages)))


def split_pages(pages: DataFrame) -> DataFrame:
    """Labelled pages with ``split``; store with ``partition_by='split'``.

    Hand over a stored table: cuts and result each read it.
    """
    return splits.train_test_dev(pages)


def tiny_pages(split: DataFrame) -> DataFrame:
    return splits.tiny_split(split)
