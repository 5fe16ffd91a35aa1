import random

import time

import pytest
from pyspark.sql import functions as F

from pagedater.functions import wikitext as wt
from pagedater.functions import years as yr
from pagedater.operators import markup, pages


def value(spark, build, *cells):
    names = [f"c{i}" for i in range(len(cells))]
    df = spark.createDataFrame([cells], ", ".join(f"{n} string" for n in names))
    return df.select(build(*[F.col(n) for n in names])).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("[[Catégorie:1964]] a", ["1964"]),
        ("[[catégorie: Conte |c]] [[CATÉGORIE:X]] [[Category:Y]]", ["Conte", "X", "Y"]),
        ("[[Catégorie:Foo: bar]]", ["Foo"]),
        ("[[Catégorie:Foo#part]]", ["Foo"]),
        ("[[Catégorie:B]] [[Catégorie:A]] [[Catégorie:B]]", ["A", "B"]),
        ("[[Auteur:A|B]] [[Catégories:X]] [[ Catégorie:X]]", []),
        ("[[Catégorie: ]] [[Catégorie:]]", []),
        ("<!-- [[Catégorie:1999]] --> b", []),
        ("[[Catégorie:open", []),
        ("", []),
    ],
)
def test_category_names(spark, text, expected):
    assert value(spark, wt.category_names, text) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("{{a|{{b|{{c}}}}}}x", "x"),
        ("{{" * 40 + "deep" + "}}" * 40 + "x", "x"),
        ("a {{b}} c {{d|e}} f", "a  c  f"),
        ("{{{param|x}}}y", "y"),
        ("{{open x", "{{open x"),
        ("a<!-- {{b -->c<!-- rest", "ac"),
        ("'''bold''' ''it'' it's", "bold it it's"),
        ("<div class=\"t\">a<br />b</div> 1 < 2", "ab 1 < 2"),
        ("[[A|B]] [[C]] [http://x.y/z label] [//x.y]", "B C label "),
        ("[[Fichier:f.jpg|vu par [[Auteur:C|C]] ici]]", "vu par C ici"),
        ("[[Auteur:A B]]. [[s:en:Foo]]", ". :Foo"),
        ("a\n{| class=x\n| b\n|}\nc", "a\n\nc"),
        ("plain, with {braces} and [1]", "plain, with {braces} and [1]"),
        ("l&#39;an&nbsp;mil &eacute; &#x1F600;", "l'an\u00a0mil é \U0001f600"),
        ("&amp;lt; &lt;b&gt; &unknown; &#0; &#xD800; &#1114112; & x; &", "&lt; <b> &unknown; &#0; &#xD800; &#1114112; & x; &"),
        ("a<nowiki>{{b}} [[c|d]] ''e'' &amp;</nowiki>f{{g}}", "a{{b}} [[c|d]] ''e'' &f"),
        ("<pre>\n{|\n|}\n</pre><math>x_{{1}}</math>", "\n{|\n|}\nx_{{1}}"),
        ("&#91;[A]] &#123;{b}}", "[[A]] {{b}}"),
    ],
)
def test_plain_text(spark, text, expected):
    assert value(spark, wt.plain_text, text) == expected


def test_no_category_link_is_left(spark):
    text = "x [[Catégorie: 1964]] y [[Category:1850|1850]] z [[catégorie:A]]"
    plain = value(spark, wt.plain_text, text)
    assert "1964" not in plain and "1850" not in plain and "[[" not in plain


@pytest.mark.parametrize(
    "text, expected",
    [
        ("{{TextQuality|Textes validés}}", 100),
        ("{{TextQuality|75%}}", 75),
        ("{{TextQuality|25%}} {{textquality|75%}}", 75),
        ("{{TextQuality|1=50%}}", 50),
        ("{{TextQuality|abc}}", None),
        ("{{TextQuality|}}", None),
        ("{{TextQualityX|50%}}", None),
        ("<!-- {{TextQuality|50%}} -->", None),
        ("none", None),
    ],
)
def test_text_quality(spark, text, expected):
    assert value(spark, wt.text_quality, text) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ('<pagequality level="3" user="u" />', 75),
        ('<pagequality level="0" user="u" />', 0),
        ('<pagequality user="u" /> <pagequality level="3" />', None),
        ("none", None),
    ],
)
def test_page_quality(spark, text, expected):
    assert value(spark, wt.page_quality, text) == expected


def test_quality_zero_falls_back_to_the_page_element(spark):
    text = '{{TextQuality|0%}}<pagequality level="3" />'
    assert value(spark, wt.quality, text) == 75


def test_unknown_quality_is_dropped(spark):
    df = spark.createDataFrame([(1, 0), (2, None), (3, 25)], "page_id int, quality int")
    assert [r.page_id for r in pages.known_quality(df).collect()] == [3]


@pytest.mark.parametrize(
    "text, book",
    [
        ('<pages index="A" from=1 /><pages index="B" />', "A"),
        ('<pages from=1 index="A.djvu" />', "A.djvu"),
        ("<pages index=A from=1 />", None),
        ('<pages index="A">', None),
        ('<pages index="123" />', "Own title"),
        ('<pages index="A" /> {{page|B}}', "A"),
        ("{{page|Book.djvu/46|num=4}}", "Book.djvu/46"),
        ("{{Page|24}}", "Own title"),
        ("{{page|num=4|B}}", "4"),
        ("{{pages|B}} {{Page |B}}", None),
        ("{{a|{{page|B}}}}", "B"),
        ("{{page|}}", None),
    ],
)
def test_embed_target(spark, text, book):
    if book == "4":
        book = "Own title"  # the first argument's value is a number
    assert value(spark, wt.embed_target, text, "Own title") == book


@pytest.mark.parametrize(
    "text, expected",
    [
        ("<pages index=A>", True),
        ("{{page|A}}", True),
        ("{{page}}", True),
        ("<pagesX {{pagex|A}} {{ page|A}}", False),
    ],
)
def test_transcludes(spark, text, expected):
    assert value(spark, wt.transcludes, text) is expected


@pytest.mark.parametrize(
    "fields, expected",
    [
        ("|Annee=1854|Publication=1509", ["1509", "1854"]),
        ("|Annee=vers 1820-1830 ou 1840|Publication=", ["1820-1830"]),
        ("|Annee={{lien|x|1854}}\n|Titre=1700", ["1854"]),
        ("|Annee=MDCC|Titre=1700|Annees=1600", []),
        ("| Annee=1854", []),
        ("|Annee=[[A|1854]]", ["1854"]),
        ("|Annee={{a|{{b|1854}}}}|Titre={{x|Annee=1700}}", ["1854"]),
        ("|Remarques={{x|Annee=1700}} [[y|Annee=1710]]", []),
        ("|Titre=x}} {{autre|Annee=1700", []),
        ("|Titre=x}} {{proofreadpage_index_template|Annee=1854", ["1854"]),
        ("|Annee={{x|[[y|1854]]}} <!-- |Annee=1700 -->", ["1854"]),
    ],
)
def test_index_years(spark, fields, expected):
    text = "{{:MediaWiki:Proofreadpage_index_template" + fields + "}}"
    assert value(spark, wt.index_years, text) == expected


def test_index_years_need_the_index_template(spark):
    assert value(spark, wt.index_years, "{{other|Annee=1854}}") == []
    assert value(spark, wt.index_years, "{{proofreadpage_index_template|Annee=1854") == []


def test_page_templates_lists_inner_calls_first(spark):
    df = spark.createDataFrame([(1, "{{A|x|{{B|y=1}}|z}} {{C}}")], "page_id int, text string")
    rows = [tuple(r) for r in markup.page_templates(df).orderBy("pos").collect()]
    assert rows == [(1, 0, "b", ["y=1"]), (1, 1, "c", []), (1, 2, "a", ["x", "", "z"])]


def test_page_with_everything(spark):
    """Own categories, a quality mark, nested templates, a table, a note and unparsed markup."""
    text = (
        "Premier alinéa, ''en italique''.<ref>note</ref> [[Fichier:x.png|vignette]]\n\n"
        "{{Cadre|{{sc|Nom}}|{{Lien|Livre X}}}}{{textquality|75%}}\n"
        "{| class=\"a\"\n| 1790\n|}\n<nowiki>[[Catégorie:1699]]</nowiki>\n"
        "[[Category:Poèmes]] [[Catégorie:1872|tri]]"
    )
    df = spark.createDataFrame([(1, "Page", text)], "page_id long, title string, text string")
    row = markup.page_facts(df).first()
    assert (row.categories, row.quality, row.is_text) == (["1872", "Poèmes"], 75, True)
    assert row.text.split()[:5] == ["Premier", "alinéa,", "en", "italique.note", "vignette"]
    assert "1790" not in row.text and "Nom" not in row.text


@pytest.mark.parametrize(
    "text, names",
    [
        ("<nowiki>[[Catégorie:A]]</nowiki>[[Catégorie:B]]", ["B"]),
        ("<nowiki />[[Catégorie:A]]</nowiki>", ["A"]),
        ('<syntaxhighlight lang="x">[[Catégorie:A]]</syntaxhighlight>', []),
        ("<pre>[[Catégorie:A]]", ["A"]),
    ],
)
def test_unparsed_elements(spark, text, names):
    assert value(spark, wt.category_names, text) == names


@pytest.mark.parametrize("mark", ["{{ abc ", "[[ abc ", "{| abc\n", "}} abc {{ ", "{{ abc | [[ x {| "])
def test_brackets_without_partner_take_seconds(spark, mark):
    text = mark * (1_000_000 // len(mark))
    df = spark.createDataFrame([(1, text + "}}")], "page_id long, text string")
    begin = time.time()
    assert len(markup.plain_text(df).first().text) > 0
    markup.page_templates(df).count()
    assert time.time() - begin < 60


def test_long_text_does_not_overflow(spark):
    text = "a 'b' [c {d " * 200_000 + "|Annee=" + "1" * 50_000
    df = spark.createDataFrame([(1, "Livre:x", "{{proofreadpage_index_template|Annee=" + text + "}}"), (2, "t", text)],
                               "page_id long, title string, text string")
    assert markup.page_facts(df).filter("n_chars > 0 or is_text is not null").count() == 2


@pytest.mark.parametrize(
    "categories, year",
    [
        (["1820-1830"], 1830),
        (["12345"], 1234),
        (["5793"], None),
        (["Domaine public en 2020", "1964"], 1964),
        (["Domaine public en 2020"], None),
        (["XXe siècle", "1509", "1936"], 1936),
        ([], None),
        (None, None),
    ],
)
def test_publication_year(spark, categories, year):
    df = spark.createDataFrame([(categories,)], "categories array<string>")
    assert df.select(yr.publication_year(F.col("categories"))).first()[0] == year


@pytest.mark.parametrize("year, label", [(1964, 1950), (1950, 1950), (1949, 1900), (2000, 2000)])
def test_period(spark, year, label):
    df = spark.createDataFrame([(year,)], "y int")
    assert df.select(yr.period(F.col("y"))).first()[0] == label


def test_namespaces(spark):
    titles = ["Page:A", "Livre:A", "A", "Auteur:A", "auteur:A", "Auteur", "Discussion Page:A", "A: Auteur:B", "Modèle:X"]
    df = spark.createDataFrame([(t,) for t in titles], "title string")
    kept = [r.title for r in pages.drop_namespaces(df).collect()]
    assert kept == ["Page:A", "Livre:A", "A", "auteur:A", "Auteur", "A: Auteur:B"]
    assert [r.title for r in pages.drop_namespaces(df, ["Pa", "A:"]).collect()] == [
        t for t in titles if not t.startswith(("Pa", "A:"))
    ]


def test_redirects_are_case_sensitive(spark):
    df = spark.createDataFrame([("#REDIRECTION [[A]]",), ("#REDIRECT [[A]]",), ("#redirection",)], "text string")
    assert pages.drop_redirects(df).count() == 2


LONG = "a run of words, long enough to stand aside and with l'apostrophe and 12 in it"
PIECES = [
    LONG, f" {LONG}", f" {LONG} ", f" {LONG}--", f" {LONG}'", "''", "'", " ", "\n", "\x85", " ", "{{", "}}", "{{{", "}}}", "{|", "|}", "|",
    "[[", "]]", "[", "]", "[//u ", "[https://u", "//", ":", "#", "<!--", "-->", "--", ">", "<b ", "/>", "<nowiki>", "<nowiki a", "</nowiki>",
    "&", "&amp", ";", "amp;", "&#xFDD9;", "&#65;", "catégorie:", "[[Catégorie: ", chr(0xFDD0), chr(0xFDD8), chr(0xFDD9), "1", "é",
]


def test_long_runs_go_around_the_patterns_and_change_nothing(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(1, 40))) for _ in range(3000)]
    frame = spark.createDataFrame([(t,) for t in [*texts, None, ""]], "text string")
    text = F.col("text")
    rows = frame.select(text, wt.plain_text(text).alias("got"), wt.decode_entities(wt.drop_markup(text)).alias("expected")).collect()
    assert [r for r in rows if r["got"] != r["expected"]] == []
    changed = [r for r in rows if r["text"] and LONG in r["text"] and r["got"] != r["text"]]
    assert len(changed) > 500


def test_the_patterns_read_short_texts(spark):
    text = f"'''x''' {LONG} {{{{t|{LONG}}}}} [[a|{LONG}]] " + f"{LONG} " * 50
    bare = F.regexp_replace("text", wt.RUN, "")
    frame = spark.createDataFrame([(text,)], "text string")
    assert frame.select(F.length(bare)).first()[0] < 200


FACTS = [*PIECES, "{{TextQuality|", "{{textquality|50%}}", "{{page|", f"{{{{Page|x={LONG}|", "<pages ", 'index="', '" />', '<pagequality level="', "3", "=", '"']


def test_facts_are_read_without_long_runs_and_stay_the_same(spark, monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choices(FACTS, k=rng.randint(1, 40))) for _ in range(3000)]
    titles = ["Livre:a", "T", None, "Page:a/1"]
    rows = [(i, titles[i % 4], t) for i, t in enumerate([*texts, None, ""])]
    frame = spark.createDataFrame(rows, "page_id long, title string, text string")
    read, live = [], wt.live
    monkeypatch.setattr(wt, "live", lambda text: read.append(str(text)) or live(text))
    found = markup.page_facts(frame).withColumnRenamed("text", "plain").drop("title")
    assert any("short" in column for column in read)
    title, text = F.col("title"), F.col("text")
    index, embeds = title.startswith("Livre:"), wt.transcludes(text)
    is_text = ~index & ~embeds
    categories = F.when(~index, wt.category_names(text))
    wanted = {
        "is_text": is_text,
        "categories": categories,
        "book_title": F.when(index, F.substring(title, 7, 99)).when(embeds, wt.embed_target(text, title)),
        "book_claims": F.coalesce(F.when(index, wt.index_years(text)), categories),
        "quality": F.when(is_text, wt.quality(text)),
        "plain": F.when(is_text, wt.decode_entities(wt.drop_markup(text))),
    }
    pairs = frame.select("page_id", "text", *[c.alias(f"want_{n}") for n, c in wanted.items()]).join(found, "page_id")
    rows = pairs.collect()
    assert len(rows) == len(texts) + 2
    assert [(r.text, n) for r in rows for n in wanted if r[n] != r[f"want_{n}"]] == []
    assert any(r.quality for r in rows) and any(LONG in (r.book_title or "") for r in rows)
    assert any(LONG in c for r in rows for c in r.categories or [])
