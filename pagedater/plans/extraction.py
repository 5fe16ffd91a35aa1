"""From a dump, or a table of wiki pages, to the raw page table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import session
from ..operators import books, markup, pages
from ..sources import dump, tables


def dump_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of a dump that hold wikitext: ``(page_id, title, text)``."""
    rows = pages.require_text(pages.only_wikitext(dump.read_dump(spark, path)))
    return wanted_pages(pages.project_page(rows))


def wanted_pages(df: DataFrame) -> DataFrame:
    """The cheap tests on title and text head, before any markup is read."""
    return pages.drop_redirects(pages.drop_namespaces(df))


def staged_facts(df: DataFrame, with_text: bool = True) -> tuple[DataFrame, DataFrame]:
    """Facts of wanted pages, and the books they make known, both staged.

    The markup is read once, into the one table that books and pages both come from.
    Without the text it is narrow; its character counts serve the distributions.
    """
    facts = markup.page_facts(wanted_pages(df))
    if not with_text:
        facts = facts.drop("text")
    facts = session.stage(facts, "facts")
    return facts, session.stage(books.book_categories(facts), "books")


def usable_texts(facts: DataFrame) -> DataFrame:
    """Pages with a text of their own, long enough and of known quality."""
    texts = pages.known_quality(pages.min_length(facts.filter("is_text")))
    kept = ("page_id", "title", "categories", "quality", "n_chars", "text")
    return texts.select(*[c for c in kept if c in texts.columns])


def extract(df: DataFrame, with_text: bool = True, strategy: str = "shuffle") -> DataFrame:
    """Page table to raw page table, with the categories of books restored."""
    facts, known_books = staged_facts(df, with_text)
    return books.restore_categories(usable_texts(facts), known_books, strategy)


def dated(df: DataFrame, strategy: str = "shuffle") -> DataFrame:
    """Page table to pages with their year, for counts: no texts, no category lists."""
    facts, known_books = staged_facts(df, with_text=False)
    found = books.restore_years(usable_texts(facts), known_books, strategy)
    return pages.drop_null_label(found, "pubyear")


def write_raw(spark: SparkSession, dump_path: str, out: str) -> DataFrame:
    """Dump to stored raw page table."""
    tables.write_table(pages.apply_schema(extract(dump_pages(spark, dump_path))), out)
    return tables.read_table(spark, out)
