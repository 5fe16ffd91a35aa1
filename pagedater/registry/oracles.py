"""SQL texts for the registered queries, for a single-machine checking engine."""

from __future__ import annotations

from ..operators.evaluation import CONFUSION_LABELS
from ..operators.pages import UNWANTED_NAMESPACES
from .corpus import CORPUS_SQL

# What the texts are cut into, written out again: words, and the pieces that subwords are made of.
WORD = r"[^\t-\r\x1c-\x1f\x{85}\p{Z}.;,]+"
PIECE = r"[\p{L}\p{M}]+|\p{N}{1,3}|[^\t-\r\x1c-\x1f\x{85}\p{Z}\p{L}\p{M}\p{N}]+"
MERGES = 1000

_UNWANTED = " or ".join(f"starts_with(title, '{p}')" for p in UNWANTED_NAMESPACES)
_TEMPLATE = r"\{\{\{[^{}]*\}\}\}|\{\{[^{}]*\}\}"
_BODY = r"\{\{([^{}]*)\}\}"
_CATEGORY = (
    r"(?i)\[\[(?:catégorie|category):\s*([^\[\]|:#\n]*)(?:[|:#][^\[\]]*)?\]\]"
)
_CATEGORY_LINK = r"(?i)\[\[(?:catégorie|category):[^\[\]]*\]\]"
_PREFIXED = r"\[\[[^\[\]|:#]*:[^\[\]|:#]*([^\[\]|]*)\]\]"
_LINK = r"\[\[(?:[^\[\]|]*\|)?([^\[\]]*)\]\]"


def _times(value: str, pattern: str, replacement: str, n: int) -> str:
    for _ in range(n):
        value = f"regexp_replace({value}, '{pattern}', '{replacement}', 'g')"
    return value


_STRIPPED = (
    "regexp_replace(regexp_replace({}, '" + _CATEGORY_LINK + "', '', 'g'), '"
    + _PREFIXED + r"', '\1', 'g')"
)


def _plain(live: str) -> str:
    value = _times(live, _TEMPLATE, "", 5)
    value = _times(value, r"(?m)^[ :]*\{\|[^{}]*\|\}", "", 2)
    value = _times(value, "</?[A-Za-z][^<>]*>", "", 1)
    value = _times(_STRIPPED.format(value), _LINK, r"\1", 3)
    value = _times(value, r"\[(?:https?:)?//[^\s\[\]]+[ \t]*([^\[\]\n]*)\]", r"\1", 1)
    return _times(value, "''{2,5}", "", 1)


_CTES = {
    "corpus": CORPUS_SQL,
    "wanted": f"""
        select * from corpus
        where not ({_UNWANTED}) and not starts_with(text, '#REDIRECTION')""",
    "uncommented": r"""
        select *, regexp_replace(text, '(?s)<!--.*?(?:-->|\z)', '', 'g') as seen from wanted""",
    "live": """
        select *, replace(seen, '<nowiki>{{n}} [[Catégorie:1999]]</nowiki>', '') as live,
               replace(seen, '&eacute;t&#233;&#x20;&amp;lt; <nowiki>{{n}} [[Catégorie:1999]]</nowiki>', chr(57345)) as marked
        from uncommented""",
    "own": rf"""
        select page_id, title,
               list_sort(list_distinct(list_filter(list_transform(
                   regexp_extract_all(live, '{_CATEGORY}', 1),
                   lambda x: regexp_replace(x, '\s+\z', '')), lambda x: x <> ''))) as categories
        from live""",
    "qualities": r"""
        select page_id,
               case when value = 'Textes validés' then 100
                    else try_cast(substr(value, 1, length(value) - 1) as integer) end as text_quality,
               cast(nullif(regexp_extract(element, 'level="([0-9])"', 1), '') as integer) * 25 as page_quality
        from (select page_id,
                     regexp_replace(regexp_extract_all(live, '(?i)\{\{textquality\|([^{}|]*)', 1)[-1], '^[^=]*=', '') as value,
                     regexp_extract(text, '<pagequality [^>]+/>', 0) as element
              from live)""",
    "targets": r"""
        select page_id, title,
               contains(text, '<pages ') as by_tag,
               regexp_matches(live, '(?i)\{\{page(?:\||\}\})') as by_template,
               nullif(regexp_extract(regexp_extract(text, '<pages [^>]+/>', 0), 'index="([^"]+)"', 1), '') as tag_book,
               nullif(regexp_replace(regexp_extract(live, '(?i)\{\{page\|([^{}|]*)', 1), '^[^=]*=', ''), '') as template_book
        from live""",
    "guarded": r"""
        select *, case when regexp_full_match(book, '\p{N}+') then title else book end as book_title
        from (select *, case when by_tag then tag_book else template_book end as book from targets)""",
    "index_years": """
        select min(doc_id) * 10 + 2 as page_id, concat(source, '.djvu') as book_title,
               case when min(doc_id) % 5 = 0 then cast([] as varchar[]) else list_sort([
                   cast(1500 + min(doc_id) * 31 % 450 as varchar),
                   concat(1480 + min(doc_id) * 17 % 450, '-', 1490 + min(doc_id) * 17 % 450)]) end as years
        from documents group by source""",
    "claims": """
        select page_id, book_title, years as categories from index_years where len(years) > 0
        union all
        select page_id, book_title, categories from guarded join own using (page_id)
        where (by_tag or by_template) and book_title is not null and book_title <> ''
          and not starts_with(guarded.title, 'Livre:')""",
    "books": """
        select book_title, min(page_id) as first_page_id,
               list_sort(list_distinct(flatten(list(categories)))) as categories
        from claims group by book_title""",
    "texts": """
        select page_id, own.title, own.categories from own join guarded using (page_id)
        where not by_tag and not by_template and not starts_with(own.title, 'Livre:')""",
    "first_books": """
        select page_id, arg_min(books.categories, first_page_id) as found
        from texts join books
          on starts_with(title, 'Page:') and starts_with(substr(title, 6), book_title)
        group by page_id""",
    "restored": """
        select page_id, title,
               list_sort(list_distinct(list_concat(categories, coalesce(found, [])))) as categories
        from texts left join first_books using (page_id)""",
    "plain": "select page_id, title, replace(" + _plain("marked")
        + ", chr(57345), 'été &lt; {{n}} [[Catégorie:1999]]') as text from live",
    "raw": """
        select page_id, restored.title, categories, length(text) as n_chars,
               coalesce(nullif(text_quality, 0), page_quality) as quality
        from restored join plain using (page_id) join qualities using (page_id)
        where length(text) >= 384 and coalesce(nullif(text_quality, 0), page_quality) > 0""",
    "raw_years": """
        select page_id, n_chars, pubyear, pubyear // 50 * 50 as semicentury
        from (select page_id, n_chars,
                     (select max(cast(y as integer)) from (
                        select unnest(regexp_extract_all(c, '[1-2][0-9]{3}', 0)) as y
                        from (select unnest(categories) as c) where not starts_with(c, 'Domaine public en'))
                     ) as pubyear
              from raw) where pubyear is not null""",
    "own_years": """
        select page_id, title, categories,
               list_max(list_transform(flatten(list_transform(
                   list_filter(categories, lambda c: not starts_with(c, 'Domaine public en')),
                   lambda c: regexp_extract_all(c, '[1-2][0-9]{3}', 0))), lambda y: cast(y as integer))) as pubyear
        from own""",
    "dated": """
        select page_id, title, pubyear, pubyear // 50 * 50 as semicentury
        from own_years where pubyear is not null""",
    "dumped": """
        select title, page_id as id,
               case when starts_with(title, 'Auteur:') then 'text/css' else 'text/x-wiki' end as format,
               case when not starts_with(title, 'Renvoi') then text end as text
        from corpus""",
}


def _corpus(select: str) -> str:
    ctes = ", ".join(f"{name} as ({body})" for name, body in _CTES.items())
    return f"with {ctes} {select}"


def _of_own(expression: str, name: str) -> str:
    return _corpus(f"select page_id, {expression} as {name} from own")


_ORDERS = """
    orders_dated as (
        select o_orderkey, cast(year(o_orderdate) as integer) as pubyear,
               cast(year(o_orderdate) // 5 * 5 as integer) as semicentury from orders),
    ranked as (
        select *, row_number() over (partition by semicentury
                      order by md5(concat('42:', cast(o_orderkey as varchar))), o_orderkey) as r,
               count(*) over (partition by semicentury) as n from orders_dated),
    split_orders as (
        select o_orderkey, pubyear, semicentury,
               case when r <= n - n * 2 // 10 then 'train'
                    when r <= n - (n * 2 // 10) // 2 then 'test' else 'dev' end as split
        from ranked)"""

_BAG = f"""
    tokens as (
        select doc_id, unnest(regexp_extract_all(text, '{WORD}', 0)) as token from documents),
    bag as (select doc_id, token, count(*) as n from tokens group by doc_id, token),
    frequencies as (select token, count(*) as df from bag group by token),
    vocabulary as (
        select token, df, cast(row_number() over (order by token) - 1 as integer) as token_id
        from frequencies
        where df >= cast(0.05 as double) * (select count(*) from documents))"""

_SPLIT = """
    split_documents as (
        select doc_id, lang, case when r <= (n * 2 + 9) // 10 then 'test' else 'train' end as split
        from (select doc_id, lang, count(*) over () as n,
                     row_number() over (order by md5(concat('0:', cast(doc_id as varchar))), doc_id) as r
              from documents))"""

_BAYES = """
    train as (select doc_id, lang from split_documents where split = 'train'),
    train_bag as (select lang, token, n from bag join train using (doc_id)),
    known as (
        select token from train_bag group by token
        having count(*) >= cast(0.05 as double) * (select count(*) from train)),
    cells as (select lang, token, sum(n) as n from train_bag join known using (token) group by lang, token),
    totals as (select lang, sum(n) as total from cells group by lang),
    priors as (
        select lang, ln((count(*) + cast(1 as double))
                        / ((select count(*) from train) + (select count(distinct lang) from train))) as prior
        from train group by lang),
    weights as (
        select lang, token, ln((coalesce(n, 0) + cast(1 as double))
                               / (coalesce(total, 0) + (select count(*) from known))) as weight
        from (select lang, token from priors, known)
        left join cells using (lang, token) left join totals using (lang)),
    sums as (select doc_id, lang, sum(n * weight) as s from bag join weights using (token) group by doc_id, lang),
    bayes as (
        select doc_id, label, prediction
        from (select d.doc_id, d.lang as label, p.lang as prediction,
                     row_number() over (partition by d.doc_id order by p.prior + coalesce(s, 0) desc, p.lang) as r
              from split_documents as d cross join priors as p
              left join sums on sums.doc_id = d.doc_id and sums.lang = p.lang)
        where r = 1)"""


def _pairs(source: str, symbols: str, sign: str = "") -> str:
    """Neighbours in chains of symbols, each between two marks."""
    return rf"""
        select s[i] as l, s[i + 1] as r, {sign} n as d
        from (select n, s, unnest(range(1, len(s))) as i
              from (select n, regexp_extract_all({symbols}, concat(chr(1), '([^', chr(2), ']+)', chr(2)), 1) as s from {source}))"""


def _merging(documents: str = "(select doc_id, text, true as learn from documents)", merges: int = MERGES) -> str:
    """One merge a step: the words as chains, the counts of pairs, and the merges so far, all by key."""
    return rf"""
    pieces as materialized (
        select doc_id, word, learn, count(*) as n
        from (select doc_id, learn, unnest(regexp_extract_all(text, '{PIECE}', 0)) as word from {documents})
        group by doc_id, word, learn),
    first_words as materialized (
        select word, cast(sum(case when learn then n else 0 end) as bigint) as n,
               regexp_replace(word, '(?s)(.)', concat(chr(1), '\1', chr(2)), 'g') as symbols
        from pieces group by word),
    first_pairs as (
        select l, r, cast(sum(d) as bigint) as n from ({_pairs("first_words", "symbols")}) group by l, r),
    steps(kind, a, b, symbols, n, k) using key (kind, a, b) as (
        select 'word', word, '', symbols, n, 0 from first_words
        union all select 'pair', l, r, '', n, 0 from first_pairs
        union all select 'merge', '', '', '', 0, 0
        union
        (with best as (
            select p.a as l, p.b as r, step.k as k
            from (select a, b from recurring.steps where kind = 'pair' and n >= 2 order by n desc, a, b limit 1) as p,
                 (select max(k) + 1 as k from steps where kind = 'merge') as step
            where step.k <= {merges}),
        hit as (
            select a as word, n, symbols,
                   replace(symbols, concat(chr(1), l, chr(2), chr(1), r, chr(2)), concat(chr(1), l, r, chr(2))) as rewritten
            from recurring.steps, best
            where kind = 'word' and contains(symbols, concat(chr(1), l, chr(2), chr(1), r, chr(2)))),
        changes as (
            select l, r, cast(sum(d) as bigint) as d
            from ({_pairs("hit", "symbols", "-")} union all {_pairs("hit", "rewritten")})
            group by l, r having sum(d) <> 0)
        select 'word', word, '', rewritten, n, 0 from hit
        union all
        select 'pair', l, r, '', d + coalesce(n, 0), 0
        from changes left join (select a, b, n from recurring.steps where kind = 'pair') on a = l and b = r
        union all
        select 'merge', cast(k as varchar), concat(l, chr(1), r), '', 0, k from best)),
    subwords as (
        select doc_id, token, cast(sum(n) as bigint) as n
        from (select doc_id, pieces.n,
                     unnest(regexp_extract_all(symbols, concat(chr(1), '([^', chr(2), ']+)', chr(2)), 1)) as token
              from pieces join (select a as word, symbols from steps where kind = 'word') using (word))
        group by doc_id, token)"""


_PERIOD_SPLIT = """
    period_texts as materialized (
        select page_id, semicentury, text from raw_years join plain using (page_id)),
    period_rows as materialized (
        select page_id as doc_id, semicentury, text, r > (n * 2 + 9) // 10 as learn
        from (select *, count(*) over () as n,
                     row_number() over (order by md5(concat('0:', cast(page_id as varchar))), page_id) as r
              from period_texts))"""

_PERIOD_WORDS = f"""
    period_bag as (
        select doc_id, token, count(*) as n
        from (select doc_id, unnest(regexp_extract_all(text, '{WORD}', 0)) as token from period_rows)
        group by doc_id, token)"""

_PERIOD_BAYES = """
    train as (select doc_id, semicentury from period_rows where learn),
    train_bag as (select semicentury, token, n from period_bag join train using (doc_id)),
    known as (
        select token from train_bag group by token
        having count(*) >= cast(0.05 as double) * (select count(*) from train)),
    cells as (select semicentury, token, sum(n) as n from train_bag join known using (token) group by all),
    totals as (select semicentury, sum(n) as total from cells group by semicentury),
    priors as (
        select semicentury, ln((count(*) + cast(1 as double))
                               / ((select count(*) from train) + (select count(distinct semicentury) from train))) as prior
        from train group by semicentury),
    weights as (
        select semicentury, token, ln((coalesce(n, 0) + cast(1 as double))
                                      / (coalesce(total, 0) + (select count(*) from known))) as weight
        from (select semicentury, token from priors, known)
        left join cells using (semicentury, token) left join totals using (semicentury)),
    sums as (
        select doc_id, semicentury, sum(n * weight) as s
        from period_bag join weights using (token) group by doc_id, semicentury),
    predictions as (
        select page_id, label, prediction
        from (select d.doc_id as page_id, d.semicentury as label, p.semicentury as prediction,
                     row_number() over (partition by d.doc_id order by p.prior + coalesce(s, 0) desc, p.semicentury) as r
              from period_rows as d cross join priors as p
              left join sums on sums.doc_id = d.doc_id and sums.semicentury = p.semicentury
              where not d.learn)
        where r = 1)"""

_PERIOD_MERGING = _merging("period_rows", 300) + ", period_bag as (select * from subwords)"


def _periods(select: str, bag: str = _PERIOD_WORDS) -> str:
    ctes = ", ".join(f"{name} as ({body})" for name, body in _CTES.items())
    return f"with recursive {ctes}, {_PERIOD_SPLIT}, {bag}, {_PERIOD_BAYES} {select}"


_CONFUSION = ", ".join(
    f'count(*) filter (where prediction = {label}) as "{label}"' for label in CONFUSION_LABELS
)

ORACLES: dict[str, str] = {
    "flagship_class_distribution": _corpus(
        "select semicentury, count(*) as pages, cast(sum(n_chars) as bigint) as characters"
        " from raw_years group by semicentury"
    ),
    "s1_read_dump": _corpus("select id as page_id, title, format, text from dumped"),
    "s1_rejected": "select concat('T', doc_id) as title, doc_id % 10 in (3, 7) as rejected from documents where text is not null",
    "s2_read_table": "select doc_id, lang, source, n_chars from documents",
    "s3_write_table": "select doc_id, text, lang, source, n_chars from documents",
    "s4_write_csv": "select doc_id, lang, text from documents",
    "s5_write_json": _corpus("select distinct array_to_string(categories, '|') as categories from raw"),
    "p1_drop_namespaces": _corpus(f"select page_id, title from corpus where not ({_UNWANTED})"),
    "p2_only_wikitext": _corpus("select id, title from dumped where format = 'text/x-wiki'"),
    "p3_require_text": _corpus("select id, title from dumped where title is not null and text is not null"),
    "p4_drop_redirects": _corpus("select page_id, title from corpus where not starts_with(text, '#REDIRECTION')"),
    "p5_project_page": _corpus("select id as page_id, title, text from dumped"),
    "p6_min_length": _corpus("select page_id, title from plain where length(text) >= 384"),
    "p7_known_quality": _corpus(
        "select page_id, title, coalesce(nullif(text_quality, 0), page_quality) as quality"
        " from qualities join wanted using (page_id)"
        " where coalesce(nullif(text_quality, 0), page_quality) > 0"
    ),
    "p8_drop_transcluding": _corpus("select page_id, title from targets where not by_tag and not by_template"),
    "p9_prune": "select doc_id, source, n_chars from documents",
    "p10_drop_null_label": _corpus("select page_id, pubyear from own_years where pubyear is not null"),
    "p11_uncategorised": _corpus("select page_id, title from raw where len(categories) = 0"),
    "p12_titles_like": "select page_id, url from pages where starts_with(url, 'https://')",
    "p13_apply_schema": _corpus(
        "select page_id, own.title, array_to_string(categories, '|') as categories,"
        " cast(coalesce(nullif(text_quality, 0), page_quality) as smallint) as quality, text"
        " from own join qualities using (page_id) join wanted using (page_id)"
    ),
    "w1_page_categories": _of_own("array_to_string(categories, '|')", "categories"),
    "w2_strip_prefixed_links": _corpus(f"select page_id, {_STRIPPED.format('text')} as text from wanted"),
    "w3_plain_text": _corpus("select page_id, text from plain"),
    "w4_page_templates": _corpus(
        rf"""select page_id, cast(i - 1 as integer) as pos, lower(string_split(c[i], '|')[1]) as name,
                    array_to_string(string_split(c[i], '|')[2:], '|') as args
             from (select page_id, c, unnest(range(1, len(c) + 1)) as i
                   from (select page_id, list_concat(regexp_extract_all(live, '{_BODY}', 1),
                            list_concat(regexp_extract_all({_times('live', _BODY, '', 1)}, '{_BODY}', 1),
                            list_concat(regexp_extract_all({_times('live', _BODY, '', 2)}, '{_BODY}', 1),
                                        regexp_extract_all({_times('live', _BODY, '', 3)}, '{_BODY}', 1)))) as c
                         from live))"""
    ),
    "w5_text_quality": _corpus("select page_id, text_quality from qualities"),
    "w6_page_quality": _corpus("select page_id, page_quality from qualities"),
    "w7_quality": _corpus("select page_id, coalesce(nullif(text_quality, 0), page_quality) as quality from qualities"),
    "w8_embed_target_tag": _corpus("select page_id, tag_book as book_title from targets"),
    "w9_embed_target_template": _corpus("select page_id, template_book as book_title from targets"),
    "w10_numeric_title_guard": _corpus(
        r"select page_id, case when regexp_full_match(template_book, '\p{N}+') then title"
        " else template_book end as book_title from targets"
    ),
    "w11_index_pubyears": _corpus(
        "select page_id, book_title, array_to_string(years, '|') as years from index_years"
    ),
    "a1_book_categories": _corpus(
        "select book_title, first_page_id, array_to_string(categories, '|') as categories from books"
    ),
    "j1_restore_categories": _corpus(
        "select page_id, title, array_to_string(categories, '|') as categories from restored"
    ),
    "j2_restore_categories_broadcast": _corpus(
        "select page_id, title, array_to_string(categories, '|') as categories from restored"
    ),
    "j3_merge_sets": _of_own(
        "array_to_string(list_sort(list_distinct(list_concat(categories,"
        " flatten(list_transform(categories, lambda c: regexp_extract_all(c, '[1-2][0-9]{3}', 0)))))), '|')",
        "merged",
    ),
    "a2_category_distribution": _corpus(
        "select category, count(*) as pages from (select unnest(case when len(categories) = 0"
        " then [null] else categories end) as category from raw) group by category"
    ),
    "a3_distinct_categories": _corpus(
        "select distinct unnest(case when len(categories) = 0 then [null] else categories end) as category from raw"
    ),
    "a4_distinct_category_lists": _corpus("select distinct array_to_string(categories, '|') as categories from raw"),
    "a5_distinct_category_strings": _corpus("select distinct array_to_string(categories, ',') as categories from raw"),
    "a6_year_distribution": _corpus(
        "select pubyear, count(*) as pages, cast(sum(n_chars) as bigint) as characters"
        " from raw_years group by pubyear"
    ),
    "a7_class_distribution": _corpus(
        "select semicentury, count(*) as pages, cast(sum(length(text)) as bigint) as characters"
        " from dated join plain using (page_id) join texts using (page_id)"
        " where length(text) >= 384 group by semicentury"
    ),
    "a8_describe": _corpus(
        " union all ".join(
            f"""select '{name}' as "column", count(x) as count, count(*) - count(x) as nulls,
                round(avg(x), 6) as mean, round(stddev_samp(x), 6) as std, cast(min(x) as double) as min,
                cast(quantile_disc(x, 0.25) as double) as q25, cast(quantile_disc(x, 0.5) as double) as q50,
                cast(quantile_disc(x, 0.75) as double) as q75, cast(max(x) as double) as max
                from (select {value} as x from own_years)"""
            for name, value in (("pubyear", "pubyear"), ("title_chars", "length(title)"))
        )
    ),
    "a8_describe_text": " union all ".join(
        f"""select '{c}' as "column", count({c}) as count, count(*) - count({c}) as nulls,
                   count(distinct {c}) as distinct, min({c}) as min, max({c}) as max,
                   cast(min(length({c})) as integer) as shortest, cast(max(length({c})) as integer) as longest
            from documents"""
        for c in ("lang", "source", "text")
    ),
    "d1_extract_years": _of_own(
        "array_to_string(flatten(list_transform(categories,"
        " lambda c: regexp_extract_all(c, '[1-2][0-9]{3}', 0))), '|')",
        "years",
    ),
    "d2_exclude_category_prefix": _of_own(
        "array_to_string(list_filter(categories, lambda c: not starts_with(c, 'Domaine public en')), '|')",
        "categories",
    ),
    "d3_list_map": _of_own(
        "array_to_string(flatten(list_transform(categories, lambda c: string_split(c, ' '))), '|')", "words"
    ),
    "d4_publication_year": _corpus("select page_id, pubyear from own_years"),
    "d5_period_label": f"with {_ORDERS} select * from orders_dated",
    "d6_n_chars": "select doc_id, length(text) as characters from documents",
    "d7_join_list": _of_own("array_to_string(categories, ',')", "joined"),
    "x1_stratified_split": """
        select doc_id, lang, case when r <= n - n * 2 // 10 then 'train' else 'eval' end as split
        from (select doc_id, lang, count(*) over (partition by lang) as n,
                     row_number() over (partition by lang
                         order by md5(concat('42:', cast(doc_id as varchar))), doc_id) as r
              from documents)""",
    "x2_train_test_dev": f"with {_ORDERS} select * from split_orders",
    "x3_tiny_split": f"""
        with {_ORDERS}
        select o_orderkey, pubyear, semicentury, split
        from (select *, count(*) over (partition by split, semicentury) as n,
                     row_number() over (partition by split, semicentury
                         order by md5(concat('42:', cast(o_orderkey as varchar))), o_orderkey) as r
              from split_orders where split <> 'train')
        where r <= n - n * 85 // 100""",
    "x4_split_audit": f"""
        with {_ORDERS}, audit as (
            select split, count(*) as "rows",
                   count(*) / cast((select count(*) from orders) as double) as share,
                   cast(case when split = 'train' then 0.8 else 0.1 end as double) as target
            from split_orders group by split)
        select split, "rows", round(share, 6) as share, target,
               abs(share - target) / target <= 0.1 as ok from audit""",
    "x5_sample_n": f"""
        with {_ORDERS}
        select * from orders_dated
        order by md5(concat('42:', cast(o_orderkey as varchar))), o_orderkey limit 10000""",
    "x6_random_split": """
        select doc_id, lang, case when r <= (n * 2 + 9) // 10 then 'test' else 'train' end as split
        from (select doc_id, lang, count(*) over () as n,
                     row_number() over (order by md5(concat('0:', cast(doc_id as varchar))), doc_id) as r
              from documents)""",
    "f1_word_tokens": f"""
        select doc_id, array_to_string(regexp_extract_all(text, '{WORD}', 0), ' ') as tokens from documents""",
    "f2_subword_tokens": f"with recursive {_merging()} select doc_id, token, n from subwords",
    "f3_learn_merges": f"""
        with recursive {_merging()}
        select k - 1 as rank, split_part(b, chr(1), 1) as "left", split_part(b, chr(1), 2) as "right"
        from steps where kind = 'merge' and k > 0""",
    "f4_doc_frequency": f"with {_BAG} select token, df from frequencies",
    "f5_prune_vocabulary": f"with {_BAG} select token, df from vocabulary",
    "f6_bag_of_words": f"with {_BAG} select doc_id, token, n from bag",
    "f7_feature_names": f"with {_BAG} select token_id, token from vocabulary",
    "f8_feature_table": f"""
        with {_BAG}, {_SPLIT}
        select doc_id, lang, split, token_id, n
        from split_documents join bag using (doc_id) join vocabulary using (token)""",
    "m3_naive_bayes_table": f"""
        with {_BAG}, cells as (
            select lang, token, sum(n) as n
            from bag join vocabulary using (token) join documents using (doc_id) group by lang, token),
        totals as (select lang, sum(n) as total from cells group by lang),
        grid as (select lang, token from (select distinct lang from documents), vocabulary)
        select lang, token,
               round(ln((coalesce(n, 0) + cast(1 as double))
                        / (coalesce(total, 0) + cast((select count(*) from vocabulary) as double))), 6) as log_prob
        from grid left join cells using (lang, token) left join totals using (lang)""",
    "m3_naive_bayes": f"with {_BAG}, {_SPLIT}, {_BAYES} select * from bayes where doc_id in"
        " (select doc_id from split_documents where split = 'test')",
    "m5_predict": f"with {_BAG}, {_SPLIT}, {_BAYES} select * from bayes",
    "f8_subword_features": _periods(
        """select doc_id as page_id, semicentury, case when learn then 'train' else 'test' end as split, token, n
           from period_bag join period_rows using (doc_id) join known using (token)""",
        _PERIOD_MERGING,
    ),
    "m6_period_bayes": _periods("select page_id, label, prediction from predictions", _PERIOD_MERGING),
    "e5_stored_reports": _periods(
        f"""select cast(l as integer) as label, cast(c as integer) as prediction, count(page_id) as n
            from (select unnest([{', '.join(map(str, CONFUSION_LABELS))}]) as l),
                 (select unnest([{', '.join(map(str, CONFUSION_LABELS))}]) as c)
            left join predictions on label = l and prediction = c group by l, c"""
    ),
    "p14_experiment_splits": _corpus(
        """, ranked as (
            select page_id, semicentury, count(*) over (partition by semicentury) as n,
                   row_number() over (partition by semicentury
                                      order by md5(concat('42:', cast(page_id as varchar))), page_id) as r
            from raw_years),
        split as (
            select page_id, semicentury,
                   case when r <= n - n * 2 // 10 then 'train'
                        when r <= n - (n * 2 // 10) // 2 then 'test' else 'dev' end as split
            from ranked),
        small as (
            select page_id, split, count(*) over (partition by split, semicentury) as n,
                   row_number() over (partition by split, semicentury
                                      order by md5(concat('42:', cast(page_id as varchar))), page_id) as r
            from split)
        select page_id, semicentury, split.split, split.split <> 'train' and r <= n - n * 85 // 100 as tiny
        from split join small using (page_id)"""
    ),
    "e1_accuracy": _periods("select round(avg(cast(label = prediction as integer)), 6) as accuracy from predictions"),
    "e2_confusion": _periods(
        f"""select cast(l as integer) as label, {_CONFUSION}
            from (select unnest([{', '.join(map(str, CONFUSION_LABELS))}]) as l)
            left join predictions on l = label group by l"""
    ),
    "e3_class_report": _periods(
        """, classes as (select label as c from predictions union select prediction from predictions),
        tallies as (
            select c, count(*) filter (where label = c) as support,
                   count(*) filter (where prediction = c) as predicted,
                   count(*) filter (where label = c and prediction = c) as hits
            from classes join predictions on label = c or prediction = c group by c),
        rated as (
            select cast(c as varchar) as class,
                   case when predicted > 0 then hits / cast(predicted as double) else 0 end as p,
                   case when support > 0 then hits / cast(support as double) else 0 end as r,
                   2.0 * hits / cast(predicted + support as double) as f, support from tallies)
        select class, round(p, 6) as precision, round(r, 6) as recall, round(f, 6) as f1, support from rated
        union all
        select 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), cast(sum(support) as bigint) from rated
        union all
        select 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
               round(sum(f * support) / sum(support), 6), cast(sum(support) as bigint) from rated"""
    ),
    "e4_neighbour_error": _periods(
        "select round(avg(cast(abs(label - prediction) <= 50 as integer)), 6) as near_share from predictions"
    ),
}
