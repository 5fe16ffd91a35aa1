import bz2
import os

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, plan_of
from pagedater import session
from pagedater.operators import distributions, pages
from pagedater.plans import extraction, labelling
from pagedater.registry import queries
from pagedater.sources import dump, tables

BODY = "Il était une fois. " * 40

DUMP = f"""<mediawiki>
  <siteinfo><sitename>wiki</sitename></siteinfo>
  <page><title>Texte</title><ns>0</ns><id>11</id>
    <revision><id>1</id><model>wikitext</model><format>text/x-wiki</format>
    <text bytes="9" xml:space="preserve">{{{{TextQuality|75%}}}} {BODY} l&#039;an &amp; &lt;i&gt;mil&lt;/i&gt; [[Catégorie:1964]]</text></revision></page>
  <page><title>Vide</title><ns>0</ns><id>12</id>
    <revision><id>2</id><model>wikitext</model><format>text/x-wiki</format><text bytes="0" /></revision></page>
  <page><title>Style</title><ns>0</ns><id>13</id>
    <revision><id>3</id><model>sanitized-css</model><format>text/css</format><text bytes="1">a</text></revision></page>
  <page><title>Auteur:A</title><ns>102</ns><id>14</id>
    <revision><id>4</id><model>wikitext</model><format>text/x-wiki</format><text bytes="1">b</text></revision></page>
  <page><title>Renvoi</title><ns>0</ns><id>15</id><redirect title="Texte" />
    <revision><id>5</id><model>wikitext</model><format>text/x-wiki</format><text bytes="1">#REDIRECTION [[Texte]]</text></revision></page>
  <page><title>Livre:L.djvu</title><ns>112</ns><id>16</id>
    <revision><id>6</id><model>proofread-index</model><format>text/x-wiki</format>
    <text bytes="1">{{{{:MediaWiki:Proofreadpage_index_template
|Titre=T
|Annee=1854
|Publication=
}}}}</text></revision></page>
  <page><title>Page:L.djvu/1</title><ns>104</ns><id>9</id>
    <revision><id>7</id><model>proofread-page</model><format>text/x-wiki</format>
    <text bytes="1">&lt;noinclude&gt;&lt;pagequality level="4" user="u" /&gt;&lt;/noinclude&gt;{BODY}</text></revision></page>
</mediawiki>"""


@pytest.fixture(scope="module")
def dump_path(tmp_path_factory):
    path = tmp_path_factory.mktemp("dump") / "pages.xml.bz2"
    path.write_bytes(bz2.compress(DUMP.encode()))
    return str(path)


def test_read_dump(spark, dump_path):
    rows = {r.title: r for r in dump.read_dump(spark, dump_path).collect()}
    assert len(rows) == 7
    assert rows["Vide"].revision.text._VALUE is None
    assert rows["Style"].revision.format == "text/css"
    assert rows["Renvoi"].redirect._title == "Texte"
    assert "l'an & <i>mil</i>" in rows["Texte"].revision.text._VALUE


def test_a_page_is_parsed_once(spark, dump_path):
    for mode in ("error", "drop"):
        assert plan_of(dump.read_dump(spark, dump_path, mode).select("id", "title")).count("from_xml(") == 1
    assert plan_of(dump.rejected_pages(spark, dump_path)).count("from_xml(") == 1


def test_damaged_pages_harm_no_other(spark, tmp_path):
    page = "<page><title>{}</title><ns>0</ns><id>{}</id>\n<revision><id>{}</id><text>{}</text></revision></page>"
    cells = [("A", 1, 1, "a"), ("B", 2, "x", "b"), ("C", 3, 3, "c <b> d"), ("D", 4, 4, "d &lt;/page&gt; e"), ("E", 5, 5, "e")]
    whole = "<mediawiki><siteinfo />" + "".join(page.format(*c) for c in cells)
    path = tmp_path / "damaged.xml.bz2"
    path.write_bytes(bz2.compress((whole + "<page><title>F</title><ns>0</ns><id>6</id><revision><id>6</id><text>cut o").encode()))
    kept = dump.read_dump(spark, str(path), "drop").collect()
    assert {r.title: r.revision.text._VALUE for r in kept} == {"A": "a", "D": "d </page> e", "E": "e"}
    assert sorted(r.title for r in dump.rejected_pages(spark, str(path)).collect()) == ["B", "C", "F"]
    with pytest.raises(Exception, match="damaged page"):
        dump.read_dump(spark, str(path)).select("title").collect()


def test_dump_of_several_splits_is_whole(spark, tmp_path):
    rows = "".join(
        f"<page><title>T{i}</title><ns>0</ns><id>{i}</id><revision><id>{i}</id><text>{os.urandom(600).hex()}</text></revision></page>\n"
        for i in range(4000)
    )
    path = tmp_path / "large.xml.bz2"
    path.write_bytes(bz2.compress(f"<mediawiki>{rows}</mediawiki>".encode(), 1))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 300_000)
    try:
        found = dump.read_dump(spark, str(path))
        assert found.rdd.getNumPartitions() > 2
        assert sorted(r.id for r in found.select("id").collect()) == list(range(4000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_dump_to_labels(spark, dump_path, scratch):
    kept = extraction.dump_pages(spark, dump_path)
    assert {r.title for r in kept.collect()} == {"Texte", "Livre:L.djvu", "Page:L.djvu/1"}
    raw = extraction.write_raw(spark, dump_path, scratch + "/raw")
    assert dict(raw.dtypes)["quality"] == "smallint"
    rows = {r.title: r for r in labelling.labelled(raw).collect()}
    assert {t: (r.pubyear, r.semicentury, r.quality) for t, r in rows.items()} == {
        "Texte": (1964, 1950, 75),
        "Page:L.djvu/1": (1854, 1850, 100),
    }
    assert "1964" not in rows["Texte"].text and rows["Page:L.djvu/1"].text == BODY


def test_require_text_drops_missing_titles(spark):
    df = spark.createDataFrame([], dump.DUMP_SCHEMA)
    assert pages.require_text(df).count() == 0


def test_split_folders_are_pruned(spark, scratch):
    df = spark.createDataFrame([(1, "train"), (2, "dev")], "page_id long, split string")
    tables.write_table(df, scratch + "/t", partition_by="split")
    assert sorted(n for n in os.listdir(scratch + "/t") if n.startswith("split=")) == ["split=dev", "split=train"]
    dev = tables.read_table(spark, scratch + "/t").filter("split = 'dev'")
    assert [r.page_id for r in dev.collect()] == [2]
    assert "PartitionFilters: [isnotnull(split" in plan_of(dev)
    assert any(n.endswith(".zstd.parquet") for n in os.listdir(scratch + "/t/split=dev"))


def test_csv_keeps_difficult_texts(spark, scratch):
    texts = ['a,"b"', "line\nbreak", "back\\slash", "'", "", None, " spaced "]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    tables.write_csv(df, scratch + "/c")
    back = tables.read_csv(spark, scratch + "/c", "id long, text string").orderBy("id")
    assert [r.text for r in back.collect()] == texts


def test_json_keeps_lists(spark, scratch):
    df = spark.createDataFrame([(["a", "é"],), ([],)], "categories array<string>")
    tables.write_json(df, scratch + "/j")
    back = spark.read.schema(df.schema).json(scratch + "/j")
    assert sorted(r.categories for r in back.collect()) == [[], ["a", "é"]]


def test_prefix_filter_and_columns_reach_the_scan(spark):
    df = queries.read(spark, SMALL, "pages")
    plan = plan_of(pages.titles_like(df, "https://", "url").select("page_id", "url"))
    assert "StringStartsWith(url,https://)" in plan
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan


def test_flagship_reads_no_text_after_staging(spark):
    plan = plan_of(queries.flagship_class_distribution(spark, SMALL))
    assert "text:string" not in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_distribution_uses_the_stored_count(spark):
    df = spark.createDataFrame([(1900, 5, "abc")], "semicentury int, n_chars long, text string")
    assert distributions.class_distribution(df).first().characters == 5
    assert distributions.class_distribution(df.drop("n_chars")).first().characters == 3


def test_staging_uses_the_shared_folder(spark, scratch, monkeypatch):
    named = spark.conf.get(session.CHECKPOINT_CONF, None)
    assert named is None or session.staging_root(spark) == named
    monkeypatch.setattr(session, "staging_root", lambda spark: scratch + "/shared/")
    staged = session.stage(spark.range(5).toDF("id"), "numbers")
    assert staged.count() == 5
    assert [n.startswith("numbers-") for n in os.listdir(scratch + "/shared")] == [True]


def test_spread_leaves_large_tables_alone(spark):
    wide = spark.range(0, 100, 1, 64).toDF("id")
    assert tables.spread(wide, "id") is wide
    assert tables.spread(wide.coalesce(1), "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_describe_is_exact(spark):
    df = spark.createDataFrame([(y,) for y in [1500, 1500, 1600, 1700, None]], "pubyear int")
    row = distributions.describe(df, "pubyear").first()
    assert (row["count"], row.nulls, row["mean"], row.q25, row.q50, row.q75, row["max"]) == (
        4, 1, 1575.0, 1500.0, 1500.0, 1600.0, 1700.0,
    )


def test_uncategorised_pages_are_counted_under_null(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],), (["a"],)], "categories array<string>")
    got = {r.category: r.pages for r in distributions.category_distribution(df).collect()}
    assert got == {"a": 2, "b": 1, None: 1}
    assert pages.uncategorised(df).count() == 1
    assert distributions.category_distribution(df).agg(F.sum("pages")).first()[0] == 4


def test_quartiles_of_many_values(spark):
    """Unique values, a hot value, nulls and an empty column, against a plain sort."""
    import random

    draw = random.Random(5)
    rows = [(draw.gauss(0, 1), 7 if draw.random() < 0.4 else draw.randrange(10**6), None) for _ in range(5003)]
    rows += [(None, 3, None)] * 40
    frame = spark.createDataFrame(rows, "a double, b long, c int").repartition(9)
    found = {r["column"]: r for r in distributions.describe(frame, "a", "b", "c").collect()}
    for name, at in (("a", 0), ("b", 1)):
        values = sorted(r[at] for r in rows if r[at] is not None)
        for share in (25, 50, 75):
            assert found[name][f"q{share}"] == values[-(-len(values) * share // 100) - 1]
        assert (found[name]["count"], found[name]["nulls"]) == (len(values), len(rows) - len(values))
    assert found["c"]["count"] == 0 and found["c"]["q50"] is None


def test_describe_text(spark):
    frame = spark.createDataFrame([("b",), ("b",), ("é",), ("",), (None,)], "t string")
    assert [tuple(r) for r in distributions.describe_text(frame, "t").collect()] == [("t", 4, 1, 3, "", "é", 0, 1)]
    assert [tuple(r) for r in distributions.describe_text(frame.limit(0), "t").collect()] == [("t", 0, 0, 0, None, None, None, None)]
