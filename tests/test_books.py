"""The prefix join against brute force and against a two-pass reading."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, plan_of
from pagedater import session
from pagedater.operators import books, labels, markup
from pagedater.plans import extraction
from pagedater.registry import queries

BOOKS = "book_title string, first_page_id long, categories array<string>"
PAGES = "page_id long, title string, categories array<string>"


def restored(spark, pages, known, strategy):
    df = books.restore_categories(
        spark.createDataFrame(pages, PAGES), spark.createDataFrame(known, BOOKS), strategy
    )
    return {r.page_id: r.categories for r in df.collect()}


def brute_force(pages, known):
    found = {}
    for page_id, title, own in pages:
        names = set(own)
        if title.startswith("Page:"):
            hits = [b for b in known if title[5:].startswith(b[0])]
            if hits:
                names |= set(min(hits, key=lambda b: b[1])[2])
        found[page_id] = sorted(names)
    return found


CASES = {
    "empty winner hides a later book": (
        [(9, "Page:X.djvu/1", [])],
        [("X", 1, []), ("X.djvu", 2, ["1900"])],
    ),
    "prefix clash": ([(9, "Page:X2.djvu/1", [])], [("X", 1, ["1800"]), ("X2.djvu", 2, ["1900"])]),
    "book with a slash seen first": (
        [(9, "Page:X.djvu/46", []), (10, "Page:X.djvu/461", []), (11, "Page:X.djvu/5", [])],
        [("X.djvu/46", 1, ["1700"]), ("X.djvu", 2, ["1900"])],
    ),
    "book with a slash seen last": (
        [(9, "Page:X.djvu/46", [])],
        [("X.djvu/46", 3, ["1700"]), ("X.djvu", 2, ["1900"])],
    ),
    "longer than the title": ([(9, "Page:X", ["a"])], [("X.djvu", 1, ["1900"])]),
    "not a scanned page": ([(9, "X.djvu/1", ["a"])], [("X", 1, ["1900"])]),
    "own and restored": ([(9, "Page:X/1", ["a", "b"])], [("X", 1, ["b", "c"])]),
    "no books": ([(9, "Page:X/1", ["a"])], []),
}


@pytest.mark.parametrize("strategy", ["shuffle", "broadcast"])
@pytest.mark.parametrize("case", sorted(CASES))
def test_cases(spark, case, strategy):
    pages, known = CASES[case]
    assert restored(spark, pages, known, strategy) == brute_force(pages, known)


@pytest.mark.parametrize("strategy, rows", [("shuffle", session.BROADCAST_ROWS), ("shuffle", 1), ("broadcast", session.BROADCAST_ROWS)])
def test_random_titles(spark, monkeypatch, strategy, rows):
    monkeypatch.setattr(session, "BROADCAST_ROWS", rows)
    rng = random.Random(7)

    def name():
        return "".join(rng.choice("ab/é") for _ in range(rng.randint(1, 5)))

    titles = sorted({name() for _ in range(120)})
    order = rng.sample(range(1000), len(titles))
    known = [(t, o, [str(1500 + o)] if o % 3 else []) for t, o in zip(titles, order)]
    pages = [(i, ("Page:" if i % 5 else "") + name() + name(), ["own"] if i % 2 else []) for i in range(400)]
    assert restored(spark, pages, known, strategy) == brute_force(pages, known)


def test_hot_book_and_order_of_rows(spark):
    """A third of the pages in one book; row order and partitions do not matter."""
    rng = random.Random(1)
    pages = [(i, f"Page:Hot.djvu/{i}" if i % 3 == 0 else f"Page:B{i % 50}.djvu/{i}", []) for i in range(3000)]
    known = [("Hot", 1, ["1900"]), *[(f"B{i}.djvu", 10 + i, [str(1800 + i)]) for i in range(50)]]
    expected = brute_force(pages, known)
    assert restored(spark, pages, known, "shuffle") == expected
    rng.shuffle(pages)
    rng.shuffle(known)
    assert restored(spark, pages, known, "shuffle") == expected


def test_beyond_the_bound_the_broadcast_form_shuffles(spark, monkeypatch):
    pages, known = CASES["prefix clash"]
    monkeypatch.setattr(session, "BROADCAST_ROWS", 1)
    assert not session.fits_broadcast(spark.createDataFrame(known, BOOKS))
    assert restored(spark, pages, known, "broadcast") == brute_force(pages, known)


def test_long_titles_count_as_bytes(spark, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_BYTES", 1000)
    assert session.fits_broadcast(spark.createDataFrame([("X", 1, [])], BOOKS))
    assert not session.fits_broadcast(spark.createDataFrame([("X" * 2000, 1, [])], BOOKS))


def test_no_nested_loop_and_no_product(spark):
    facts = spark.createDataFrame([(1, "Page:A/1", ["x"])], PAGES)
    known = spark.createDataFrame([("A", 1, ["y"])], BOOKS)
    for strategy in ("shuffle", "broadcast"):
        plan = plan_of(books.restore_categories(facts, known, strategy))
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_text_is_shuffled(spark, scratch):
    rows = [(1, "Page:A/1", ["x"], "t"), (2, "Page:A/b/2", ["x"], "t"), (3, "C", [], "t"), (4, None, None, None)]
    schema = "page_id long, title string, categories array<string>, text string"
    spark.createDataFrame(rows, schema).write.parquet(scratch + "/pages")
    known = spark.createDataFrame([("A", 5, ["y"]), ("A/b", 1, ["z"])], BOOKS)
    joined = books.restore_categories(spark.read.parquet(scratch + "/pages"), known)
    assert "Exchange" not in plan_of(joined).replace("BroadcastExchange", "")
    found = {r["page_id"]: (r["categories"], r["text"]) for r in joined.collect()}
    assert found == {1: (["x", "y"], "t"), 2: (["x", "z"], "t"), 3: ([], "t"), 4: ([], None)}


def test_unknown_strategy(spark):
    with pytest.raises(ValueError):
        restored(spark, *CASES["prefix clash"], "other")


def claims(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, title string, text string")
    return {r.book_title: (r.first_page_id, r.categories) for r in books.book_categories(df).collect()}


def test_book_categories(spark):
    index = "{{:MediaWiki:Proofreadpage_index_template|Annee=%s}}"
    rows = [
        (7, "Œuvre", '<pages index="X.djvu" /> [[Catégorie:B]] [[Catégorie:A]]'),
        (3, "Livre:X.djvu", index % "1854"),
        (4, "Livre:None.djvu", index % "s. d."),
        (5, "Vide", '<pages index="E" />'),
        (6, "Nu", '<pages index="" /> [[Catégorie:C]]'),
        (8, "Court", "{{page|X.djvu|num=1}} [[Catégorie:A]]"),
        (9, "Numéro", "{{page|24}} [[Catégorie:D]]"),
    ]
    assert claims(spark, rows) == {
        "X.djvu": (3, ["1854", "A", "B"]),
        "E": (5, []),
        "Numéro": (9, ["D"]),
    }


def test_two_passes_over_the_corpus_give_the_same(spark):
    """One join equals reading the pages in order and correcting them afterwards."""
    facts = session.stage(markup.page_facts(queries.wanted(spark, SMALL)).drop("text"), "facts")
    known = session.stage(books.book_categories(facts), "books")
    rows = facts.orderBy("page_id").collect()
    seen, out = defaultdict(set), {}

    def lookup(title):
        for book, names in seen.items():
            if title[5:].startswith(book):
                return set(names)
        return set()

    early = 0
    for row in rows:
        if row.title.startswith("Livre:"):
            if row.book_claims:
                seen[row.book_title] |= set(row.book_claims)
        elif not row.is_text:
            if row.book_title:
                seen[row.book_title] |= set(row.book_claims)
        else:
            out[row.page_id] = (row.title, set(row.categories))
            if row.title.startswith("Page:"):
                early += not lookup(row.title)
                out[row.page_id][1].update(lookup(row.title))
    for title, names in out.values():
        if title.startswith("Page:"):
            names |= lookup(title)
    joined = books.restore_categories(facts.filter("is_text"), known)
    ours = {r.page_id: set(r.categories) for r in joined.select("page_id", "categories").collect()}
    assert ours == {page_id: names for page_id, (_, names) in out.items()}
    assert early > 0, "no page came before its book"


def test_years_alone_give_the_same_labels(spark):
    corpus = queries.corpus(spark, SMALL)
    short = extraction.dated(corpus).select("page_id", "pubyear", "n_chars")
    full = labels.clean_pages(extraction.extract(corpus, with_text=False))
    assert sorted(short.collect()) == sorted(full.select("page_id", "pubyear", "n_chars").collect())
    assert short.count() > 0


def test_corpus_exercises_every_kind(spark):
    facts = session.stage(markup.page_facts(queries.wanted(spark, SMALL)).drop("text"), "facts")
    known = books.book_categories(facts)
    assert known.filter("size(categories) = 0").count() > 0
    assert known.filter(F.contains("book_title", F.lit("/"))).count() > 0
    raw = queries.raw(spark, SMALL)
    assert raw.filter("size(categories) > 0 and title like 'Page:%'").count() > 0
