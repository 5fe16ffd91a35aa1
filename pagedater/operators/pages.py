"""Choosing and shaping pages: the cheap, row-local steps that run first."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import wikitext as wt

# Title prefixes of the namespaces that hold no text to date.
UNWANTED_NAMESPACES = (
    "Média:",
    "Spécial:",
    "Discussion:",
    "Utilisateur:",
    "Discussion utilisateur:",
    "Wikisource:",
    "Discussion Wikisource:",
    "Fichier:",
    "Discussion fichier:",
    "MediaWiki:",
    "Discussion MediaWiki:",
    "Modèle:",
    "Discussion modèle:",
    "Aide:",
    "Discussion aide:",
    "Catégorie:",
    "Discussion catégorie:",
    "Transwiki:",
    "Discussion Transwiki:",
    "Auteur:",
    "Discussion Auteur:",
    "Discussion Page:",
    "Portail:",
    "Discussion Portail:",
    "Discussion Livre:",
    "TimedText:",
    "TimedText talk:",
    "Module:",
    "Discussion module:",
    "Sujet:",
)
# Formats, marks and limits.
WIKITEXT_FORMAT = "text/x-wiki"
REDIRECT = "#REDIRECTION"
MIN_CHARACTERS = 384


def drop_namespaces(df: DataFrame, prefixes: Iterable[str] = UNWANTED_NAMESPACES) -> DataFrame:
    """Drop pages whose title starts with one of the prefixes (case-sensitive).

    A namespace ends at the first colon, so one hash look-up of the title's head
    replaces a test per prefix. Prefixes of another form are tested one by one.
    """
    prefixes = list(prefixes)
    heads = [p[:-1] for p in prefixes if p.find(":") == len(p) - 1]
    others = [p for p in prefixes if p.find(":") != len(p) - 1]
    title = F.col("title")
    unwanted = F.contains(title, F.lit(":")) & F.substring_index(title, ":", 1).isin(heads)
    for prefix in others:
        unwanted = unwanted | title.startswith(prefix)
    return df.filter(~unwanted)


def only_wikitext(df: DataFrame) -> DataFrame:
    return df.filter(F.col("revision.format") == WIKITEXT_FORMAT)


def require_text(df: DataFrame) -> DataFrame:
    """Drop dump rows without a title or without a text."""
    return df.filter(F.col("title").isNotNull() & F.col("revision.text._VALUE").isNotNull())


def project_page(df: DataFrame) -> DataFrame:
    """Dump row to ``(page_id, title, text)``."""
    return df.select(
        F.col("id").alias("page_id"), "title", F.col("revision.text._VALUE").alias("text")
    )


def drop_redirects(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("text").startswith(REDIRECT))


def min_length(df: DataFrame, n: int = MIN_CHARACTERS, text: str = "text") -> DataFrame:
    """Keep texts of at least ``n`` characters; meant for text without markup.

    A stored count, ``n_chars``, saves reading the text.
    """
    length = F.col("n_chars") if "n_chars" in df.columns else F.length(text)
    return df.filter(length >= n)


def known_quality(df: DataFrame) -> DataFrame:
    """Drop pages of unknown quality: NULL or 0."""
    return df.filter(F.col("quality") > 0)


def drop_transcluding(df: DataFrame) -> DataFrame:
    """Drop pages that embed other pages, whose text is elsewhere."""
    return df.filter(~wt.transcludes(F.col("text")))


def prune(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns)


def drop_null_label(df: DataFrame, column: str = "pubyear") -> DataFrame:
    return df.na.drop(subset=[column])


def uncategorised(df: DataFrame) -> DataFrame:
    return df.filter(F.size("categories") == 0)


def titles_like(df: DataFrame, prefix: str, column: str = "title") -> DataFrame:
    """Look up rows by prefix; reaches the parquet scan as a pushed filter."""
    return df.filter(F.col(column).startswith(prefix))


def apply_schema(df: DataFrame) -> DataFrame:
    """Stored types of the raw page table."""
    return df.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("title").cast("string").alias("title"),
        F.col("categories").cast("array<string>").alias("categories"),
        F.col("quality").cast("smallint").alias("quality"),
        F.col("text").cast("string").alias("text"),
    )
