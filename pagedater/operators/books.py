"""Books: their categories, and the prefix join that brings them to scanned pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import session
from ..functions import wikitext as wt
from ..functions import years as yr
from . import markup


def book_claims(df: DataFrame) -> DataFrame:
    """``(page_id, book_title, book_claims)`` of the pages that make a book known.

    An embedding page makes its book known even without any category; an index page
    only when it states a year. An empty book title would match every page and is
    dropped. Takes a page table or the facts of one.
    """
    facts = df if "book_claims" in df.columns else markup.page_claims(df)
    is_index = F.col("title").startswith(wt.INDEX_PREFIX)
    return facts.filter(
        (F.col("book_title") != "") & (~is_index | (F.size("book_claims") > 0))
    ).select("page_id", "book_title", "book_claims")


def book_categories(df: DataFrame) -> DataFrame:
    """Per book: where it was first seen, and the union of the categories claimed.

    Claims are reduced to distinct (book, category) pairs before they are gathered,
    so a book claimed by very many pages never collects more than its own result.
    """
    pairs = (
        book_claims(df)
        .select("page_id", "book_title", F.explode_outer("book_claims").alias("category"))
        .groupBy("book_title", "category")
        .agg(F.min("page_id").alias("first_page_id"))
    )
    return pairs.groupBy("book_title").agg(
        F.min("first_page_id").alias("first_page_id"),
        F.array_sort(F.collect_set("category")).alias("categories"),
    )


def _stem(title: Column) -> Column:
    """Title up to the first slash."""
    return F.substring_index(title, "/", 1)


def _lengths(books: DataFrame) -> Column:
    """The distinct lengths of book titles: one small array, bounded by the longest."""
    return books.select(F.collect_set(F.length("book_title"))).scalar().alias("lengths")


def _prefixes(titles: DataFrame, key: str, title: str) -> DataFrame:
    """``(key, book_title)`` with the prefixes of a title at its ``lengths``, none twice."""
    short_enough = F.filter("lengths", lambda n: n <= F.length(title))
    prefixes = F.transform(short_enough, lambda n: F.substring(F.col(title), F.lit(1), n))
    return titles.select(key, F.explode(prefixes).alias("book_title"))


def _earliest(matches: DataFrame, key: str, prefix: str) -> DataFrame:
    """Earliest-seen book per key. A key has one match per prefix length at most."""
    return matches.groupBy(key).agg(
        F.min("first_page_id").alias(f"{prefix}_seen"),
        F.min_by("payload", "first_page_id").alias(f"{prefix}_payload"),
    )


def _scans(pages: DataFrame) -> DataFrame:
    name = F.substring("title", len(wt.SCAN_PREFIX) + 1, 1 << 30)
    return pages.filter(F.col("title").startswith(wt.SCAN_PREFIX)).select(
        "page_id", name.alias("scan")
    )


def _lookups(scans: DataFrame, books: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two tables, by hash joins only: the first book without a slash per stem of scanned
    pages, and the first book with one per page.

    A book without a slash in its title is a prefix of a page title exactly when it
    is a prefix of the title's stem, so its candidates are made per distinct stem:
    once for the hundreds of pages of a book. A book with a slash shares its whole
    stem with the page, so only pages of such stems get candidates of their own, at
    the title lengths known for that stem.
    """
    plain = books.filter(~F.contains("book_title", F.lit("/")))
    pathed = books.filter(F.contains("book_title", F.lit("/"))).withColumn(
        "stem", _stem(F.col("book_title"))
    )
    scans = scans.withColumn("stem", _stem(F.col("scan")))
    stems = scans.select("stem").distinct().select("stem", _lengths(plain))
    by_stem = _earliest(
        _prefixes(stems, "stem", "stem").join(plain, "book_title"), "stem", "plain"
    )

    stem_lengths = pathed.groupBy("stem").agg(
        F.collect_set(F.length("book_title")).alias("lengths")
    )
    of_stem = scans.join(stem_lengths, "stem")
    by_title = _earliest(
        _prefixes(of_stem, "page_id", "scan").join(pathed.drop("stem"), "book_title"),
        "page_id",
        "pathed",
    )

    return by_stem, by_title


def _of_both() -> Column:
    """The payload of the earlier one of a page's two candidates."""
    pathed_wins = F.coalesce(F.col("pathed_seen") < F.col("plain_seen"), F.lit(True))
    return F.when(F.col("pathed_seen").isNotNull() & pathed_wins, F.col("pathed_payload")).otherwise(F.col("plain_payload"))


def _first_book_by_stem(scans: DataFrame, books: DataFrame) -> DataFrame:
    """First matching book per scanned page."""
    by_stem, by_title = _lookups(scans, books)
    found = scans.withColumn("stem", _stem(F.col("scan"))).join(by_stem, "stem", "left").join(by_title, "page_id", "left")
    return found.filter(
        F.col("plain_seen").isNotNull() | F.col("pathed_seen").isNotNull()
    ).select("page_id", _of_both().alias("payload"))


def _first_book_broadcast(scans: DataFrame, books: DataFrame) -> DataFrame:
    """First matching book per scanned page with all books on every executor."""
    candidates = _prefixes(scans.select("page_id", "scan", _lengths(books)), "page_id", "scan")
    matches = candidates.join(F.broadcast(books), "book_title")
    return _earliest(matches, "page_id", "any").select(
        "page_id", F.col("any_payload").alias("payload")
    )


def first_book(
    pages: DataFrame, books: DataFrame, payload: Column, strategy: str = "shuffle"
) -> DataFrame:
    """``(page_id, payload)`` of the first-seen book of every scanned page that has one."""
    known = books.select("book_title", "first_page_id", payload.alias("payload"))
    if strategy not in ("shuffle", "broadcast"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy == "broadcast" and session.fits_broadcast(known):
        return _first_book_broadcast(_scans(pages), known)
    return _first_book_by_stem(_scans(pages), known)


def _in_place(pages: DataFrame, by_stem: DataFrame, by_title: DataFrame) -> DataFrame:
    """Pages with ``payload``, looked up where they are: no page moves."""
    scan = F.when(
        F.coalesce(F.col("title").startswith(wt.SCAN_PREFIX), F.lit(False)),
        F.substring("title", len(wt.SCAN_PREFIX) + 1, 1 << 30),
    )
    return (
        pages.withColumn("stem", _stem(scan))
        .join(F.broadcast(by_stem), "stem", "left")
        .join(F.broadcast(by_title), "page_id", "left")
        .withColumn("payload", _of_both())
    )


def restore_categories(
    pages: DataFrame, books: DataFrame, strategy: str = "shuffle"
) -> DataFrame:
    """Give every scanned page the categories of the first-seen book it belongs to.

    A page belongs to a book when its title, without the namespace, starts with the
    book's title; among several books the one with the smallest ``first_page_id``
    counts, even with no categories. The joins work on ``(page_id, title)`` only. What they
    find is small, as all pages of a book share a stem: a row per stem, and one per page of
    books with a slash in their title. Both are counted, and looked up where the pages
    are, so that no text is shuffled. Beyond the bound of a broadcast the scanned pages meet
    their payload on the unique ``page_id``; all other pages go past that join.

    ``books`` is read several times; hand over a staged table. ``strategy="broadcast"``
    is for few books: it is checked, and beyond the bound the shuffle form runs.
    """
    if strategy == "shuffle":
        known = books.select("book_title", "first_page_id", F.col("categories").alias("payload"))
        by_stem, by_title = (session.stage(t, "found") for t in _lookups(_scans(pages), known))
        if session.fits_broadcast(by_stem) and session.fits_broadcast(by_title):
            joined = _in_place(pages, by_stem, by_title)
            return joined.withColumn("categories", yr.merge_sets(F.col("categories"), F.col("payload"))).select(pages.columns)
    found = first_book(pages, books, F.col("categories"), strategy)
    is_scan = F.coalesce(F.col("title").startswith(wt.SCAN_PREFIX), F.lit(False))
    scans = pages.filter(is_scan).join(found, "page_id", "left")
    others = pages.filter(~is_scan).withColumn("payload", F.lit(None).cast("array<string>"))
    return (
        scans.unionByName(others)
        .withColumn("categories", yr.merge_sets(F.col("categories"), F.col("payload")))
        .select(pages.columns)
    )


def restore_years(pages: DataFrame, books: DataFrame, strategy: str = "shuffle") -> DataFrame:
    """Add ``pubyear`` over the own categories and those of the book, and drop the lists.

    The same year as after ``restore_categories``, but only years go through the
    joins: the most recent year of a union is the later one of its parts.
    """
    found = first_book(pages, books, yr.publication_year(F.col("categories")), strategy)
    own = pages.withColumn("own_year", yr.publication_year(F.col("categories")))
    return (
        own.drop("categories")
        .join(found, "page_id", "left")
        .withColumn("pubyear", F.greatest("own_year", "payload"))
        .drop("own_year", "payload")
    )
