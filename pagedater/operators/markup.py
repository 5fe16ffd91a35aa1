"""Wikitext extraction over a page table ``(page_id, title, text)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import wikitext as wt
from ..functions import years as yr


def page_categories(df: DataFrame) -> DataFrame:
    return df.withColumn("categories", wt.category_names(F.col("text")))


def strip_prefixed_links(df: DataFrame) -> DataFrame:
    return df.withColumn("text", wt.strip_prefixed_links(F.col("text")))


def plain_text(df: DataFrame) -> DataFrame:
    return df.withColumn("text", wt.plain_text(F.col("text")))


def page_templates(df: DataFrame) -> DataFrame:
    """One row per template call: ``(page_id, pos, name, args)``, name in lower case."""
    calls = df.select("page_id", F.posexplode(wt.template_calls(F.col("text"))))
    parts = F.split("col", r"\|")
    return calls.select(
        "page_id",
        "pos",
        F.lower(F.element_at(parts, 1)).alias("name"),
        F.slice(parts, F.lit(2), F.size(parts)).alias("args"),
    )


def text_quality(df: DataFrame) -> DataFrame:
    return df.withColumn("text_quality", wt.text_quality(F.col("text")))


def page_quality(df: DataFrame) -> DataFrame:
    return df.withColumn("page_quality", wt.page_quality(F.col("text")))


def quality(df: DataFrame) -> DataFrame:
    return df.withColumn("quality", wt.quality(F.col("text")))


def embed_target_tag(df: DataFrame) -> DataFrame:
    return df.withColumn("book_title", wt.embed_target_tag(F.col("text")))


def embed_target_template(df: DataFrame) -> DataFrame:
    return df.withColumn("book_title", wt.embed_target_template(F.col("text")))


def numeric_title_guard(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "book_title", wt.numeric_title_guard(F.col("book_title"), F.col("title"))
    )


def index_pubyears(df: DataFrame) -> DataFrame:
    """Index pages with their book title and the years they state."""
    pages = df.filter(F.col("title").startswith(wt.INDEX_PREFIX))
    return pages.select(
        "page_id",
        F.substring("title", len(wt.INDEX_PREFIX) + 1, 1 << 30).alias("book_title"),
        wt.index_years(F.col("text")).alias("years"),
    )


def _named_book(seen: Column, embeds: Column, whole: Callable[[Column], Column] = wt.as_is) -> Column:
    """The book of an index page, or of one that embeds others."""
    title, text = F.col("title"), F.col("text")
    is_index = title.startswith(wt.INDEX_PREFIX)
    own = F.substring(title, len(wt.INDEX_PREFIX) + 1, 1 << 30)
    return F.when(is_index, own).when(embeds, wt.live_target(seen, text, title, whole))


def page_claims(df: DataFrame) -> DataFrame:
    """``(page_id, title, book_title, book_claims)`` of ``page_facts``, and no more work than they need."""
    is_index = F.col("title").startswith(wt.INDEX_PREFIX)

    def facts(seen: Column) -> Column:
        return wt.bind(
            wt.live_transcludes(seen, F.col("text")),
            lambda embeds: F.struct(
                _named_book(seen, embeds).alias("book_title"),
                F.when(is_index, wt.live_index_years(seen))
                .when(embeds, wt.live_categories(seen))
                .alias("book_claims"),
            ),
        )

    return df.select("page_id", "title", wt.bind(wt.live(F.col("text")), facts).alias("facts")).select(
        "page_id", "title", "facts.*"
    )


def page_facts(df: DataFrame) -> DataFrame:
    """Everything that is read off a page's markup, in one pass over the text.

    Adds the own ``categories``, ``quality``, the plain ``text`` and ``n_chars``,
    and for index and embedding pages ``book_title`` with ``book_claims``, the
    categories they give to that book. ``is_text`` marks pages that may become rows
    of the raw table. Plain text is made for those pages only. All patterns but those of
    index pages read the text without its long runs, which what they find gets back.
    """
    title, text, parts, short = F.col("title"), F.col("text"), F.col("parts"), F.col("short")
    is_index = title.startswith(wt.INDEX_PREFIX)

    def whole(found: Column) -> Column:
        return wt.with_runs(found, parts)

    def facts(seen: Column) -> Column:
        def by_kind(embeds: Column) -> Column:
            is_text = ~is_index & ~embeds
            return F.struct(
                is_text.alias("is_text"),
                F.when(~is_index, wt.live_categories(seen, whole)).alias("categories"),
                _named_book(seen, embeds, whole).alias("book_title"),
                F.when(is_index, wt.index_years(text)).alias("index_years"),
                F.when(is_text, wt.live_quality(seen, short, whole)).alias("quality"),
            )

        return wt.bind(wt.live_transcludes(seen, short), by_kind)

    split = df.select("page_id", "title", "text", wt.split_runs(text).alias("parts"))
    split = split.select("*", wt.without_runs(text, parts).alias("short"))
    found = split.select("*", wt.bind(wt.live(short), facts).alias("facts"))
    plain = F.when(parts.isNull() | wt.has_marks(short), wt.plain_without_runs(short, parts)).otherwise(text)
    read = found.select(
        "page_id", "title", "facts.*", F.when(F.col("facts.is_text"), plain).alias("text")
    )
    return read.select(
        "page_id",
        "title",
        "is_text",
        "categories",
        "book_title",
        F.coalesce("index_years", "categories").alias("book_claims"),
        "quality",
        yr.n_chars(F.col("text")).alias("n_chars"),
        "text",
    )
