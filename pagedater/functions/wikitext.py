"""Wikitext as column expressions.

Patterns avoid look-around and possessive forms, so that the same text also runs
in RE2 engines. Nested markup is removed from the inside out, with exactly as many
passes as the row nests levels.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from html.entities import name2codepoint
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names and attributes of the wiki.
SCAN_PREFIX = "Page:"
INDEX_PREFIX = "Livre:"
VALIDATED = "Textes validés"
EMBED_TAG = "<pages "
UNPARSED = ("nowiki", "pre", "math", "syntaxhighlight")

# Patterns.
COMMENT = r"(?s)<!--.*?(?:-->|\z)"
TEMPLATE = r"\{\{(?:\{[^{}]*\}\}\}|[^{}]*\}\})"
TEMPLATE_BODY = r"\{\{([^{}]*)\}\}"
TABLE = r"(?m)^[ :]*\{\|[^{}]*\|\}"
TAG = r"</?[A-Za-z][^<>]*>"
CATEGORY_LINK = r"\[\[(?iu:catégorie|category):[^\[\]]*\]\]"
CATEGORY_NAME = r"\[\[(?iu:catégorie|category):\s*([^\[\]|:#\n]*)(?:[|:#][^\[\]]*)?\]\]"
PREFIXED_LINK = r"\[\[[^\[\]|:#]*:[^\[\]|:#]*([^\[\]|]*)\]\]"
LINK = r"\[\[(?:[^\[\]|]*\|)?([^\[\]]*)\]\]"
OUTER_LINK = r"\[(?:https?:)?//[^\s\[\]]+[ \t]*([^\[\]\n]*)\]"
QUOTES = r"'{2,5}"
TEXT_QUALITY = r"\{\{(?i:textquality)\|([^{}|]*)"
PAGE_QUALITY = r"<pagequality [^>]+/>"
PAGE_QUALITY_LEVEL = r'level="([0-9])"'
EMBED_ELEMENT = r"<pages [^>]+/>"
EMBED_INDEX = r'index="([^"]+)"'
EMBED_TEMPLATE = r"\{\{(?i:page)\|([^{}|]*)"
EMBED_TEMPLATE_CALL = r"\{\{(?i:page)(?:\||\}\})"
INDEX_TEMPLATE = r"(?i)\{\{[^{}|]*proofreadpage_index_template"
INDEX_YEAR_FIELDS = r"(?s)^(?:Annee|Publication)=.*"
INNER_CALL = r"\{\{[^{}]*\}\}"
INNER_LINK = r"\[\[[^\[\]]*\]\]"
YEAR_RANGE = r"[0-9]{4}(?:-[0-9]{4})?"
NUMERIC = r"^\p{N}+\z"
ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
# Alternatives share their first characters, so that most places are passed at once.
UNPARSED_ELEMENT = "(?s)<(?:" + "|".join(
    rf"{name}(?:\s[^<>]*[^<>/])?>.*?</{name}>" for name in UNPARSED
) + ")"
UNPARSED_CONTENT = r"(?s)^<[^<>]*>(.*)</[a-z]+>\z"

# Characters of markup, and code points that no text may hold to stand for them.
# The last one only says that a text has some.
MARKUP = "{}[]<>'|"
MASKS = "".join(chr(0xFDD0 + i) for i in range(len(MARKUP)))
MASKED = chr(0xFDD0 + len(MARKUP))

# Long runs of running text: what no pattern of ``plain_text`` can tell from a stand-in.
# A run follows a space and holds no line break and none of these characters, but for
# apostrophes that stand alone; it ends in no white space and no hyphen (``-->``). The class
# is ASCII, as Java is slow on others; texts with other line ends or stand-ins have no runs.
RUN_MARK = chr(0xFDD0 + len(MARKUP) + 1)
NO_RUN = r"{}\[\]<>'|&:#/;\n\r\x0B\f"
RUN = rf" ([^{NO_RUN} \t-][^{NO_RUN}]{{24,}}(?:'[^{NO_RUN}]+){{0,100}}[^{NO_RUN} \t-])"
LINE_ENDS = "\x85\u2028\u2029"
MARKS = ("<", "{{", "{|", "[[", "//", "''", "&")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def as_is(value: Column) -> Column:
    return value


def nonempty(value: Column) -> Column:
    """NULL instead of an empty string (what a pattern without a match gives)."""
    return bind(value, lambda v: F.when(v != "", v))


def where_found(text: Column, mark: str, rewrite: Callable[[Column], Column]) -> Column:
    """Rewrite only texts that hold ``mark``: a byte search is far cheaper than a pattern."""
    return bind(
        text, lambda t: F.when(F.contains(t, F.lit(mark)), rewrite(t)).otherwise(t)
    )


def nesting(text: Column, opening: str, closing: str) -> Column:
    """Upper bound of the nesting depth of a bracket pair, per row.

    The depth counts where a bracket meets its partner, read from either end, so that
    brackets without one add no passes.
    """
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("deepest"))

    def deepest(marks: Column, entering: str) -> Column:
        def step(state: Column, mark: Column) -> Column:
            return F.when(
                mark == entering.replace("\\", ""),
                F.struct(
                    (state["depth"] + 1).alias("depth"),
                    state["deepest"].alias("deepest"),
                ),
            ).otherwise(
                F.struct(
                    F.greatest(state["depth"] - 1, F.lit(0)).alias("depth"),
                    F.greatest(state["deepest"], state["depth"]).alias("deepest"),
                )
            )

        return F.aggregate(marks, start, step, lambda state: state["deepest"])

    marks = F.regexp_extract_all(text, F.lit(f"{opening}|{closing}"), F.lit(0))
    return bind(
        marks, lambda m: F.least(deepest(m, opening), deepest(F.reverse(m), closing))
    )


def rewrite_nested(
    text: Column, pattern: str, replacement: str, opening: str, closing: str
) -> Column:
    """Apply a replacement of innermost matches once per nesting level."""
    return where_found(
        text,
        opening.replace("\\", ""),
        lambda t: F.aggregate(
            F.array_repeat(F.lit(0), nesting(t, opening, closing)),
            t,
            lambda rest, _: F.regexp_replace(rest, pattern, replacement),
        ),
    )


def rewrite_matches(text: Column, pattern: str, rewrite: Callable[[Column], Column]) -> Column:
    """Put ``rewrite(match)`` in the place of every match of a pattern."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), rewrite)
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("before"), found.alias("match"))
    pairs = F.transform(parts, lambda p: F.array(p["before"], F.coalesce(p["match"], F.lit(""))))
    return F.array_join(F.flatten(pairs), "")


def mask(text: Column) -> Column:
    """Markup characters as their stand-ins, so that no pattern sees them."""
    return F.translate(text, MARKUP, MASKS)


def mask_nested(text: Column, pattern: str, opening: str, closing: str) -> Column:
    """Mask innermost matches once per nesting level."""
    return where_found(
        text,
        opening.replace("\\", ""),
        lambda t: F.aggregate(
            F.array_repeat(F.lit(0), nesting(t, opening, closing)),
            t,
            lambda rest, _: rewrite_matches(rest, pattern, mask),
        ),
    )


def mask_unparsed(text: Column) -> Column:
    """Elements whose content is no markup, as that content with its markup masked."""

    def content(element: Column) -> Column:
        return F.concat(F.lit(MASKED), mask(F.regexp_replace(element, UNPARSED_CONTENT, "$1")))

    return bind(
        text,
        lambda t: F.when(
            reduce(or_, [F.contains(t, F.lit(f"</{name}>")) for name in UNPARSED]),
            rewrite_matches(t, UNPARSED_ELEMENT, content),
        ).otherwise(t),
    )


def unmask(text: Column) -> Column:
    return where_found(text, MASKED, lambda t: F.translate(t, MASKS + MASKED, MARKUP))


def code_point(number: Column) -> Column:
    """The character of a number; NULL where there is none."""
    valid = ((number > 0) & (number < 0xD800)) | ((number > 0xDFFF) & (number < 0x110000))
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))


def decode_entities(text: Column) -> Column:
    """Numbered and named (HTML 4) character entities as characters; others stay."""
    pairs = "\x01".join(f"{name}\x02{chr(n)}" for name, n in sorted(name2codepoint.items()))
    named = F.str_to_map(F.lit(pairs), F.lit("\x01"), F.lit("\x02"))

    def decoded(entity: Column) -> Column:
        name = F.substring(entity, F.lit(2), F.length(entity) - 2)
        digits = F.substring(name, F.lit(2), F.length(name))
        hexadecimal = F.substring(name, F.lit(3), F.length(name))
        number = F.when(
            F.lower(name).startswith("#x"), F.conv(hexadecimal, 16, 10).try_cast("int")
        ).otherwise(digits.try_cast("int"))
        found = F.when(F.startswith(entity, F.lit("&#")), bind(number, code_point)).otherwise(F.try_element_at(named, name))
        return F.coalesce(found, entity)

    return where_found(text, "&", lambda t: rewrite_matches(t, ENTITY, decoded))


def drop_comments(text: Column) -> Column:
    return where_found(text, "<!--", lambda t: F.regexp_replace(t, COMMENT, ""))


def live(text: Column) -> Column:
    """Text without comments and without elements whose content is no markup.

    The functions named ``live_`` take it as it is, so that a row that needs several of
    them makes it once (``bind``).
    """
    text = drop_comments(text)
    for name in UNPARSED:
        element = rf"(?s)<{name}(?:\s[^<>]*[^<>/])?>.*?</{name}>"
        text = where_found(text, f"</{name}>", lambda t, e=element: F.regexp_replace(t, e, ""))
    return text


def drop_templates(text: Column) -> Column:
    return rewrite_nested(text, TEMPLATE, "", r"\{\{", r"\}\}")


def drop_tables(text: Column) -> Column:
    return rewrite_nested(text, TABLE, "", r"\{\|", r"\|\}")


def drop_tags(text: Column) -> Column:
    return where_found(text, "<", lambda t: F.regexp_replace(t, TAG, ""))


def strip_prefixed_links(text: Column) -> Column:
    """Remove category links whole, and ``key:value`` of every other unpiped link.

    A category link shows nothing on the page, and its name or sort key may hold
    the year to be predicted. Piped links keep their visible text.
    """
    return where_found(
        text,
        "[[",
        lambda t: F.regexp_replace(
            F.regexp_replace(t, CATEGORY_LINK, ""), PREFIXED_LINK, "$1"
        ),
    )


def unwrap_links(text: Column) -> Column:
    """Replace links by their visible text, inner links first."""
    text = rewrite_nested(text, LINK, "$1", r"\[\[", r"\]\]")
    return where_found(text, "//", lambda t: F.regexp_replace(t, OUTER_LINK, "$1"))


def drop_quotes(text: Column) -> Column:
    return where_found(text, "''", lambda t: F.regexp_replace(t, QUOTES, ""))


def plain_text(text: Column) -> Column:
    """Wikitext to plain text: comments, templates, tables, tags, links, quotes, entities.

    What stands in ``nowiki``, ``pre``, ``math`` and ``syntaxhighlight`` stays as written.
    Tables go whole: their cells are headings and figures, not running text. Entities
    come last and once, so that what they spell is no markup. The patterns read a text
    without its long runs (``RUN``), which stand-ins keep the places of.
    """

    return bind(
        text,
        lambda t: F.when(
            refuses_runs(t) | has_marks(t), bind(split_runs(t), lambda parts: plain_around_runs(t, parts))
        ).otherwise(t),
    )


def has_marks(text: Column) -> Column:
    return reduce(or_, [F.contains(text, F.lit(mark)) for mark in MARKS])


def holds_stand_ins(text: Column) -> Column:
    """Whether a text may hold stand-ins: their first two bytes, of three, are the same."""
    return F.contains(text.cast("binary"), F.lit(bytearray(RUN_MARK.encode()[:2])))


def drop_markup(text: Column) -> Column:
    """Text without markup; entities stay."""
    text = mask_unparsed(drop_comments(text))
    text = drop_tags(drop_tables(drop_templates(text)))
    text = drop_quotes(unwrap_links(strip_prefixed_links(text)))
    return unmask(text)


def refuses_runs(text: Column) -> Column:
    """Whether a text has other line ends or stand-ins, and goes through the patterns whole."""
    return reduce(or_, [F.contains(text, F.lit(c)) for c in LINE_ENDS], holds_stand_ins(text))


def split_runs(text: Column) -> Column:
    """Even places hold what is between the runs, odd ones the runs; NULL for a text that can have none."""
    return F.when(~refuses_runs(text), F.split(F.regexp_replace(text, RUN, f" {RUN_MARK}$1{RUN_MARK}"), RUN_MARK, -1))


def without_runs(text: Column, parts: Column) -> Column:
    """The text with its runs' numbers in their places; as it is where ``parts`` is NULL."""
    numbers = F.transform(parts, lambda p, i: F.when(i % 2 == 0, p).otherwise(i.cast("string")))
    return F.coalesce(F.array_join(numbers, RUN_MARK), text)


def with_runs(short: Column, parts: Column, between: Callable[[Column], Column] = as_is) -> Column:
    """The runs back in the places of their numbers, in (a piece of) ``without_runs``."""

    def restored(left: Column) -> Column:
        whole = F.transform(
            left, lambda p, i: F.when(i % 2 == 0, between(p)).otherwise(F.get(parts, p.cast("int")))
        )
        return F.array_join(whole, "")

    return bind(
        short,
        lambda s: F.when(parts.isNotNull() & F.contains(s, F.lit(RUN_MARK)), restored(F.split(s, RUN_MARK, -1))).otherwise(
            between(s)
        ),
    )


def plain_around_runs(text: Column, parts: Column) -> Column:
    """Plain text of one with its ``split_runs``: a run goes through the patterns as its number."""
    return plain_without_runs(without_runs(text, parts), parts)


def plain_without_runs(short: Column, parts: Column) -> Column:
    return with_runs(drop_markup(short), parts, decode_entities)


def category_names(text: Column) -> Column:
    """Sorted set of the category names a page links to."""
    return live_categories(live(text))


def live_categories(seen: Column, whole: Callable[[Column], Column] = as_is) -> Column:
    names = F.regexp_extract_all(seen, F.lit(CATEGORY_NAME), F.lit(1))
    names = F.transform(names, lambda n: F.regexp_replace(whole(n), r"\s+\z", ""))
    return F.array_sort(F.array_distinct(F.filter(names, lambda n: n != "")))


def template_calls(text: Column) -> Column:
    """Bodies of all template calls, innermost level first, left to right in a level.

    An outer call is listed with its inner calls blanked.
    """
    return bind(live(text), live_calls)


def live_calls(seen: Column) -> Column:
    start = F.struct(seen.alias("rest"), F.array().cast("array<string>").alias("calls"))

    def peel(state: Column, _: Column) -> Column:
        found = F.regexp_extract_all(state["rest"], F.lit(TEMPLATE_BODY), F.lit(1))
        return F.struct(
            F.regexp_replace(state["rest"], TEMPLATE_BODY, "").alias("rest"),
            F.concat(state["calls"], found).alias("calls"),
        )

    levels = F.array_repeat(F.lit(0), nesting(seen, r"\{\{", r"\}\}"))
    return F.aggregate(levels, start, peel, lambda state: state["calls"])


def argument_value(argument: Column) -> Column:
    """Value of a template argument: what follows ``name=``, or all of it."""
    return F.regexp_replace(argument, r"^[^=]*=", "")


def text_quality(text: Column) -> Column:
    """Quality of the last ``TextQuality`` template, 0-100; NULL when unreadable."""
    return live_text_quality(live(text))


def live_text_quality(seen: Column, whole: Callable[[Column], Column] = as_is) -> Column:
    marks = F.regexp_extract_all(seen, F.lit(TEXT_QUALITY), F.lit(1))
    return bind(
        argument_value(whole(F.try_element_at(marks, F.lit(-1)))),
        lambda value: F.when(value == VALIDATED, F.lit(100)).otherwise(
            F.regexp_replace(value, r"(?s).\z", "").try_cast("int")
        ),
    )


def page_quality(text: Column, whole: Callable[[Column], Column] = as_is) -> Column:
    """Level 0-4 of the first ``pagequality`` element, times 25; NULL without one."""
    level = F.regexp_extract(whole(F.regexp_extract(text, PAGE_QUALITY, 0)), PAGE_QUALITY_LEVEL, 1)
    return level.try_cast("int") * 25


def quality(text: Column) -> Column:
    """Template quality unless missing or 0, else the page element's."""
    return live_quality(live(text), text)


def live_quality(seen: Column, text: Column, whole: Callable[[Column], Column] = as_is) -> Column:
    stated = bind(live_text_quality(seen, whole), lambda q: F.when(q != 0, q))
    return F.coalesce(stated, page_quality(text, whole))


def embeds_by_tag(text: Column) -> Column:
    return F.contains(text, F.lit(EMBED_TAG))


def embeds_by_template(text: Column) -> Column:
    return live(text).rlike(EMBED_TEMPLATE_CALL)


def transcludes(text: Column) -> Column:
    """Whether a page embeds other pages, by tag or by template."""
    return embeds_by_tag(text) | embeds_by_template(text)


def live_transcludes(seen: Column, text: Column) -> Column:
    return embeds_by_tag(text) | seen.rlike(EMBED_TEMPLATE_CALL)


def embed_target_tag(text: Column) -> Column:
    """Book named by the first self-closing ``pages`` element, or NULL."""
    element = F.regexp_extract(text, EMBED_ELEMENT, 0)
    return nonempty(F.regexp_extract(element, EMBED_INDEX, 1))


def embed_target_template(text: Column) -> Column:
    """Book named by the first argument of the first ``page`` template, or NULL."""
    return live_target_template(live(text))


def live_target_template(seen: Column, whole: Callable[[Column], Column] = as_is) -> Column:
    argument = whole(F.regexp_extract(seen, EMBED_TEMPLATE, 1))
    return nonempty(argument_value(argument))


def numeric_title_guard(book: Column, title: Column) -> Column:
    """A book name made of digits only gives way to the page's own title."""
    return bind(book, lambda b: F.when(b.rlike(NUMERIC), title).otherwise(b))


def embed_target(text: Column, title: Column) -> Column:
    """Book that an embedding page belongs to. The tag decides before the template."""
    return live_target(live(text), text, title)


def live_target(
    seen: Column, text: Column, title: Column, whole: Callable[[Column], Column] = as_is
) -> Column:
    book = F.when(embeds_by_tag(text), embed_target_tag(text)).otherwise(live_target_template(seen, whole))
    return numeric_title_guard(book, title)


def index_years(text: Column) -> Column:
    """Sorted set of the first year or range of each date field of an index page.

    Only arguments of the index template itself count, with all that their value holds:
    inner links and calls are masked, so that the first closing is the template's own.
    A template that never closes has no arguments.
    """
    return live_index_years(live(text))


def live_index_years(seen: Column) -> Column:

    def arguments(rest: Column) -> Column:
        inner = mask_nested(rest, INNER_LINK, r"\[\[", r"\]\]")
        inner = mask_nested(inner, INNER_CALL, r"\{\{", r"\}\}")
        call = bind(
            inner,
            lambda t: F.when(F.contains(t, F.lit("}}")), F.substring_index(t, "}}", 1)).otherwise(""),
        )
        return F.split(call, r"\|")

    after = F.split(seen, INDEX_TEMPLATE, -1)
    calls = F.slice(after, F.lit(2), F.size(after))
    fields = F.filter(
        F.flatten(F.transform(calls, arguments)), lambda f: f.rlike(INDEX_YEAR_FIELDS)
    )
    years = F.transform(fields, lambda f: F.regexp_extract(f, YEAR_RANGE, 0))
    return F.array_sort(F.array_distinct(F.filter(years, lambda y: y != "")))
