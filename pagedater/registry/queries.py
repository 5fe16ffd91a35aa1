"""Registered queries: one per operator, each over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import NaiveBayesModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..functions import wikitext as wt
from ..functions import years as yr
from ..operators import (
    books,
    distributions,
    evaluation,
    labels,
    markup,
    models,
    pages,
    splits,
    subwords,
    tokens,
)
from ..plans import experiment, extraction, labelling
from ..sources import dump, tables
from .corpus import CORPUS_SQL

Query = Callable[[SparkSession, str], DataFrame]

MERGES = 1_000
PERIOD_MERGES = 300

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its function name."""
    QUERIES[build.__name__] = build
    return build


# --- inputs -----------------------------------------------------------------


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return tables.read_table(spark, f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "documents")


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents, on all cores, for the work that is heavy per row."""
    return tables.spread(documents(spark, sf), "doc_id")


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    source = documents(spark, sf)
    source.createOrReplaceTempView("documents")
    return tables.spread(spark.sql(CORPUS_SQL), "page_id", source)


def wanted(spark: SparkSession, sf: str) -> DataFrame:
    return extraction.wanted_pages(corpus(spark, sf))


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return extraction.extract(corpus(spark, sf), with_text=False)


def own_categories(spark: SparkSession, sf: str) -> DataFrame:
    return markup.page_categories(wanted(spark, sf)).select("page_id", "title", "categories")


def dated_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with a year in their own categories, labelled."""
    dated = labels.publication_year(own_categories(spark, sf))
    return labels.period_label(labels.drop_null_label(dated)).select(
        "page_id", "title", "pubyear", "semicentury"
    )


def dated_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by five-year period: a labelled table with many rows."""
    year = F.year("o_orderdate").alias("pubyear")
    rows = read(spark, sf, "orders").select("o_orderkey", year)
    return labels.period_label(rows, width=5)


def as_dump(spark: SparkSession, sf: str) -> DataFrame:
    """The corpus in the shape of dump rows, with style sheets and empty texts among them."""
    title = F.col("title")
    text = F.when(~title.startswith("Renvoi"), F.col("text"))
    return corpus(spark, sf).select(
        title,
        F.lit(0).alias("ns"),
        F.col("page_id").alias("id"),
        F.lit(None).cast("struct<_title string>").alias("redirect"),
        F.struct(
            (F.col("page_id") + 1).alias("id"),
            F.lit("wikitext").alias("model"),
            F.when(title.startswith("Auteur:"), "text/css")
            .otherwise(pages.WIKITEXT_FORMAT)
            .alias("format"),
            F.struct(text.alias("_VALUE"), F.length(text).cast("bigint").alias("_bytes")).alias("text"),
        ).alias("revision"),
    )


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- flagship ---------------------------------------------------------------


@query
def flagship_class_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return labelling.class_distribution(corpus(spark, sf))


# --- sources and sinks ------------------------------------------------------


@query
def s1_read_dump(spark: SparkSession, sf: str) -> DataFrame:
    path = session.staging_path(spark, "dump")
    dump.write_dump(as_dump(spark, sf), path)
    return dump.read_dump(spark, path).select(
        F.col("id").alias("page_id"),
        "title",
        F.col("revision.format").alias("format"),
        F.col("revision.text._VALUE").alias("text"),
    )


@query
def s1_rejected(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as a dump in which every tenth page has an unreadable number, and others a stray tag."""
    doc_id = F.col("doc_id")
    number = F.when(doc_id % 10 == 3, F.lit("x")).otherwise(doc_id.cast("string"))
    stray = F.when(doc_id % 10 == 7, F.lit("<b>")).otherwise(F.lit(""))
    escaped = F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    page = F.concat(
        F.lit("<page><title>T"), doc_id, F.lit("</title><ns>0</ns><id>"), number, F.lit("</id><revision><id>1</id><text>"),
        escaped, stray, F.lit("</text></revision></page>"),
    )
    path = session.staging_path(spark, "damaged")
    documents(spark, sf).filter("text is not null").select(page.alias("value")).write.text(path)
    bad = dump.rejected_pages(spark, path).select("title", F.lit(True).alias("rejected"))
    good = dump.read_dump(spark, path, "drop").select("title", F.lit(False).alias("rejected"))
    return bad.unionByName(good)


@query
def s2_read_table(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("doc_id", "lang", "source", "n_chars")


@query
def s3_write_table(spark: SparkSession, sf: str) -> DataFrame:
    path = session.staging_path(spark, "table")
    tables.write_table(documents(spark, sf), path, partition_by="lang")
    return tables.read_table(spark, path)


@query
def s4_write_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = session.staging_path(spark, "csv")
    rows = documents(spark, sf).select("doc_id", "lang", "text")
    tables.write_csv(rows, path)
    return tables.read_csv(spark, path, "doc_id bigint, lang string, text string")


@query
def s5_write_json(spark: SparkSession, sf: str) -> DataFrame:
    path = session.staging_path(spark, "json")
    tables.write_json(distributions.distinct_category_lists(raw(spark, sf)), path)
    lists = spark.read.schema("categories array<string>").json(path)
    return lists.select(F.array_join("categories", "|").alias("categories"))


# --- projection, filter, predicate ------------------------------------------


def _ids(df: DataFrame) -> DataFrame:
    return df.select("page_id", "title")


@query
def p1_drop_namespaces(spark: SparkSession, sf: str) -> DataFrame:
    return _ids(pages.drop_namespaces(corpus(spark, sf)))


@query
def p2_only_wikitext(spark: SparkSession, sf: str) -> DataFrame:
    return pages.only_wikitext(as_dump(spark, sf)).select("id", "title")


@query
def p3_require_text(spark: SparkSession, sf: str) -> DataFrame:
    return pages.require_text(as_dump(spark, sf)).select("id", "title")


@query
def p4_drop_redirects(spark: SparkSession, sf: str) -> DataFrame:
    return _ids(pages.drop_redirects(corpus(spark, sf)))


@query
def p5_project_page(spark: SparkSession, sf: str) -> DataFrame:
    return pages.project_page(as_dump(spark, sf))


@query
def p6_min_length(spark: SparkSession, sf: str) -> DataFrame:
    plain = wt.plain_text(F.col("text"))
    counted = wanted(spark, sf).select("page_id", "title", yr.n_chars(plain).alias("n_chars"))
    return _ids(pages.min_length(session.stage(counted, "counted")))


@query
def p7_known_quality(spark: SparkSession, sf: str) -> DataFrame:
    rated = markup.quality(wanted(spark, sf)).select("page_id", "title", "quality")
    return pages.known_quality(session.stage(rated, "rated"))


@query
def p8_drop_transcluding(spark: SparkSession, sf: str) -> DataFrame:
    return _ids(pages.drop_transcluding(wanted(spark, sf)))


@query
def p9_prune(spark: SparkSession, sf: str) -> DataFrame:
    return pages.prune(documents(spark, sf), "doc_id", "source", "n_chars")


@query
def p10_drop_null_label(spark: SparkSession, sf: str) -> DataFrame:
    dated = labels.publication_year(own_categories(spark, sf))
    return labels.drop_null_label(dated).select("page_id", "pubyear")


@query
def p11_uncategorised(spark: SparkSession, sf: str) -> DataFrame:
    return pages.uncategorised(raw(spark, sf)).select("page_id", "title")


@query
def p12_titles_like(spark: SparkSession, sf: str) -> DataFrame:
    return pages.titles_like(read(spark, sf, "pages"), "https://", "url").select("page_id", "url")


@query
def p13_apply_schema(spark: SparkSession, sf: str) -> DataFrame:
    rows = markup.quality(markup.page_categories(wanted(spark, sf)))
    return pages.apply_schema(rows).withColumn("categories", F.array_join("categories", "|"))


# --- wikitext extraction ----------------------------------------------------


@query
def w1_page_categories(spark: SparkSession, sf: str) -> DataFrame:
    names = markup.page_categories(wanted(spark, sf))
    return names.select("page_id", F.array_join("categories", "|").alias("categories"))


@query
def w2_strip_prefixed_links(spark: SparkSession, sf: str) -> DataFrame:
    return markup.strip_prefixed_links(wanted(spark, sf)).select("page_id", "text")


@query
def w3_plain_text(spark: SparkSession, sf: str) -> DataFrame:
    return markup.plain_text(wanted(spark, sf)).select("page_id", "text")


@query
def w4_page_templates(spark: SparkSession, sf: str) -> DataFrame:
    calls = markup.page_templates(wanted(spark, sf))
    return calls.select("page_id", "pos", "name", F.array_join("args", "|").alias("args"))


@query
def w5_text_quality(spark: SparkSession, sf: str) -> DataFrame:
    return markup.text_quality(wanted(spark, sf)).select("page_id", "text_quality")


@query
def w6_page_quality(spark: SparkSession, sf: str) -> DataFrame:
    return markup.page_quality(wanted(spark, sf)).select("page_id", "page_quality")


@query
def w7_quality(spark: SparkSession, sf: str) -> DataFrame:
    return markup.quality(wanted(spark, sf)).select("page_id", "quality")


@query
def w8_embed_target_tag(spark: SparkSession, sf: str) -> DataFrame:
    return markup.embed_target_tag(wanted(spark, sf)).select("page_id", "book_title")


@query
def w9_embed_target_template(spark: SparkSession, sf: str) -> DataFrame:
    return markup.embed_target_template(wanted(spark, sf)).select("page_id", "book_title")


@query
def w10_numeric_title_guard(spark: SparkSession, sf: str) -> DataFrame:
    named = markup.embed_target_template(wanted(spark, sf))
    return markup.numeric_title_guard(named).select("page_id", "book_title")


@query
def w11_index_pubyears(spark: SparkSession, sf: str) -> DataFrame:
    found = markup.index_pubyears(wanted(spark, sf))
    return found.select("page_id", "book_title", F.array_join("years", "|").alias("years"))


# --- books ------------------------------------------------------------------


@query
def a1_book_categories(spark: SparkSession, sf: str) -> DataFrame:
    known = books.book_categories(wanted(spark, sf))
    return known.select(
        "book_title", "first_page_id", F.array_join("categories", "|").alias("categories")
    )


def _restored(spark: SparkSession, sf: str, strategy: str) -> DataFrame:
    facts = markup.page_facts(wanted(spark, sf)).drop("text", "n_chars", "quality")
    facts = session.stage(facts, "facts")
    known = session.stage(books.book_categories(facts), "books")
    texts = facts.filter("is_text").select("page_id", "title", "categories")
    found = books.restore_categories(texts, known, strategy)
    return found.select("page_id", "title", F.array_join("categories", "|").alias("categories"))


@query
def j1_restore_categories(spark: SparkSession, sf: str) -> DataFrame:
    return _restored(spark, sf, "shuffle")


@query
def j2_restore_categories_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    return _restored(spark, sf, "broadcast")


@query
def j3_merge_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Own categories joined with the years found in them."""
    years = F.transform(yr.extract_years(F.col("categories")), lambda y: y.cast("string"))
    none = F.when(F.size("categories") > 0, years)
    return own_categories(spark, sf).select(
        "page_id", F.array_join(yr.merge_sets(F.col("categories"), none), "|").alias("merged")
    )


# --- aggregation and distinct -----------------------------------------------


@query
def a2_category_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return distributions.category_distribution(raw(spark, sf))


@query
def a3_distinct_categories(spark: SparkSession, sf: str) -> DataFrame:
    return distributions.distinct_categories(raw(spark, sf))


@query
def a4_distinct_category_lists(spark: SparkSession, sf: str) -> DataFrame:
    lists = distributions.distinct_category_lists(raw(spark, sf))
    return lists.select(F.array_join("categories", "|").alias("categories"))


@query
def a5_distinct_category_strings(spark: SparkSession, sf: str) -> DataFrame:
    return distributions.distinct_category_strings(raw(spark, sf))


@query
def a6_year_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return distributions.year_distribution(labels.clean_pages(raw(spark, sf)))


@query
def a7_class_distribution(spark: SparkSession, sf: str) -> DataFrame:
    """The minimum slice: pages that carry their own categories, straight from text."""
    facts = session.stage(markup.page_facts(wanted(spark, sf)).drop("text"), "facts")
    rows = pages.min_length(facts.filter("is_text"))
    return distributions.class_distribution(labels.labelled_pages(rows))


@query
def a8_describe(spark: SparkSession, sf: str) -> DataFrame:
    dated = labels.publication_year(own_categories(spark, sf))
    rows = dated.select("pubyear", F.length("title").alias("title_chars"))
    return rounded(distributions.describe(session.stage(rows, "rows"), "pubyear", "title_chars"), "mean", "std")


@query
def a8_describe_text(spark: SparkSession, sf: str) -> DataFrame:
    return distributions.describe_text(documents(spark, sf), "lang", "source", "text")


# --- scalars ----------------------------------------------------------------


def _own(spark: SparkSession, sf: str, name: str, build: Callable[[Column], Column]) -> DataFrame:
    return own_categories(spark, sf).select("page_id", build(F.col("categories")).alias(name))


def _joined(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda v: v.cast("string")), "|")


@query
def d1_extract_years(spark: SparkSession, sf: str) -> DataFrame:
    return _own(spark, sf, "years", lambda c: _joined(yr.extract_years(c)))


@query
def d2_exclude_category_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return _own(spark, sf, "categories", lambda c: _joined(yr.exclude_category_prefix(c)))


@query
def d3_list_map(spark: SparkSession, sf: str) -> DataFrame:
    """Words of every category, as one list."""
    return _own(
        spark, sf, "words", lambda c: _joined(F.flatten(F.transform(c, lambda x: F.split(x, " "))))
    )


@query
def d4_publication_year(spark: SparkSession, sf: str) -> DataFrame:
    return labels.publication_year(own_categories(spark, sf)).select("page_id", "pubyear")


@query
def d5_period_label(spark: SparkSession, sf: str) -> DataFrame:
    return dated_orders(spark, sf)


@query
def d6_n_chars(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("doc_id", yr.n_chars(F.col("text")).alias("characters"))


@query
def d7_join_list(spark: SparkSession, sf: str) -> DataFrame:
    return _own(spark, sf, "joined", yr.join_list)


# --- splits and samples -----------------------------------------------------


@query
def x1_stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = documents(spark, sf).select("doc_id", "lang")
    return splits.stratified_split(rows, "lang", 0.2, "doc_id")


def _split_orders(spark: SparkSession, sf: str) -> DataFrame:
    return splits.train_test_dev(dated_orders(spark, sf), key="o_orderkey")


@query
def x2_train_test_dev(spark: SparkSession, sf: str) -> DataFrame:
    return _split_orders(spark, sf)


@query
def x3_tiny_split(spark: SparkSession, sf: str) -> DataFrame:
    return splits.tiny_split(_split_orders(spark, sf), key="o_orderkey")


@query
def x4_split_audit(spark: SparkSession, sf: str) -> DataFrame:
    targets = {"train": 0.8, "test": 0.1, "dev": 0.1}
    return rounded(splits.split_audit(_split_orders(spark, sf), targets), "share")


@query
def x5_sample_n(spark: SparkSession, sf: str) -> DataFrame:
    return splits.sample_n(dated_orders(spark, sf), key="o_orderkey")


@query
def x6_random_split(spark: SparkSession, sf: str) -> DataFrame:
    return splits.random_split(documents(spark, sf).select("doc_id", "lang"), key="doc_id")


# --- text features ----------------------------------------------------------


def _tokenised(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.word_tokens(texts(spark, sf))


def _vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    frequencies = tokens.doc_frequency(_tokenised(spark, sf))
    return session.stage(tokens.prune_vocabulary(frequencies, documents(spark, sf)), "vocabulary")


@query
def f1_word_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return _tokenised(spark, sf).select("doc_id", F.array_join("tokens", " ").alias("tokens"))


def _merges(docs: DataFrame) -> DataFrame:
    return subwords.learn_merges(session.stage(subwords.word_counts(docs), "words"), MERGES)


@query
def f2_subword_tokens(spark: SparkSession, sf: str) -> DataFrame:
    docs = texts(spark, sf)
    return subwords.subword_tokens(docs, _merges(docs))


@query
def f3_learn_merges(spark: SparkSession, sf: str) -> DataFrame:
    return _merges(texts(spark, sf))


@query
def f4_doc_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.doc_frequency(_tokenised(spark, sf))


@query
def f5_prune_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    frequencies = f4_doc_frequency(spark, sf)
    return tokens.prune_vocabulary(frequencies, documents(spark, sf)).select("token", "df")


@query
def f6_bag_of_words(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.bag_of_words(_tokenised(spark, sf))


@query
def f7_feature_names(spark: SparkSession, sf: str) -> DataFrame:
    frequencies = f4_doc_frequency(spark, sf)
    vocabulary = tokens.prune_vocabulary(frequencies, documents(spark, sf))
    return vocabulary.select("token_id", "token")


@query
def f8_feature_table(spark: SparkSession, sf: str) -> DataFrame:
    split = splits.random_split(documents(spark, sf).select("doc_id", "lang", "text"), key="doc_id")
    return tokens.feature_table(tokens.word_tokens(split), _vocabulary(spark, sf))


# --- models and evaluation --------------------------------------------------


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return experiment.features(texts(spark, sf), label="lang", key="doc_id")[0]


def _predicted(spark: SparkSession, sf: str, model: str) -> DataFrame:
    return experiment.run(_vectors(spark, sf), model, "lang", "doc_id")


def _facts(spark: SparkSession, sf: str, model: str) -> DataFrame:
    """Predictions of a model whose figures SQL cannot give, and what must hold of them.

    The prediction is a class of the training rows, and the accuracy over the test rows
    is at least 0.15 above the share of their largest class.
    """
    vectors = _vectors(spark, sf)
    found = session.stage(experiment.run(vectors, model, "lang", "doc_id"), "predicted")
    classes = vectors.filter("split = 'train'").select(F.collect_set("lang")).scalar()
    sizes = found.groupBy("label").agg(
        F.count("*").alias("n"), F.count_if(F.col("label") == F.col("prediction")).alias("hits")
    )
    beats = sizes.select(F.sum("hits") >= F.max("n") + F.lit(0.15) * F.sum("n")).scalar()
    return found.select(
        "doc_id",
        "label",
        "prediction",
        F.coalesce(F.array_contains(classes, F.col("prediction")), F.lit(False)).alias("known_class"),
        beats.alias("beats_majority"),
    )


@query
def m1_decision_tree(spark: SparkSession, sf: str) -> DataFrame:
    return _facts(spark, sf, "decision_tree")


@query
def m2_svm(spark: SparkSession, sf: str) -> DataFrame:
    return _facts(spark, sf, "svm")


@query
def m3_naive_bayes(spark: SparkSession, sf: str) -> DataFrame:
    return _predicted(spark, sf, "naive_bayes")


@query
def m3_naive_bayes_table(spark: SparkSession, sf: str) -> DataFrame:
    vocabulary = _vocabulary(spark, sf)
    docs = _tokenised(spark, sf).select("doc_id", "lang", "tokens")
    features = tokens.feature_table(docs, vocabulary)
    return rounded(models.naive_bayes_table(features, docs, vocabulary, "lang"), "log_prob")


@query
def m4_mlp(spark: SparkSession, sf: str) -> DataFrame:
    return _facts(spark, sf, "mlp")


@query
def m5_predict(spark: SparkSession, sf: str) -> DataFrame:
    """Every document, training rows included, classified by naive Bayes."""
    vectors = _vectors(spark, sf)
    fitted = models.naive_bayes(vectors.filter("split = 'train'"), "lang")
    return models.predict(fitted, vectors)


# --- from pages to periods ---------------------------------------------------


def period_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Usable pages with their plain text and period."""
    pages_of = labels.labelled_pages(extraction.extract(corpus(spark, sf)))
    return session.stage(pages_of.select("page_id", "semicentury", "text"), "period_texts")


def period_vectors(spark: SparkSession, sf: str, merges: int = 0) -> DataFrame:
    return experiment.features(period_texts(spark, sf), merges=merges)[0]


def predictions(spark: SparkSession, sf: str, merges: int = 0) -> DataFrame:
    """Test pages with the period that naive Bayes gives them, as a stored table."""
    return session.stage(experiment.run(period_vectors(spark, sf, merges), "naive_bayes"), "predictions")


@query
def f8_subword_features(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of byte-pair tokens of every usable page, beside period and split."""
    vectors, names = experiment.features(period_texts(spark, sf), merges=PERIOD_MERGES)
    sparse = F.unwrap_udt("features")
    pairs = F.arrays_zip(sparse["indices"].alias("token_id"), sparse["values"].alias("n"))
    listed = vectors.select("page_id", "semicentury", "split", F.explode(pairs).alias("pair"))
    rows = listed.select("page_id", "semicentury", "split", "pair.token_id", F.col("pair.n").cast("long").alias("n"))
    known = spark.createDataFrame(list(enumerate(names)), "token_id int, token string")
    return rows.join(session.broadcast_if_small(known), "token_id").drop("token_id")


@query
def m6_period_bayes(spark: SparkSession, sf: str) -> DataFrame:
    """The period of test pages from byte-pair tokens, by a model stored and read again."""
    vectors = period_vectors(spark, sf, PERIOD_MERGES)
    path = session.staging_path(spark, "model")
    models.save(models.naive_bayes(vectors.filter("split = 'train'")), path)
    fitted = models.load(spark, path, NaiveBayesModel)
    return models.predict(fitted, vectors.filter("split = 'test'"), "page_id")


@query
def e5_stored_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Report and confusion matrix of the periods, as CSV files read again."""
    path = session.staging_path(spark, "reports")
    experiment.write_report(predictions(spark, sf), path)
    schema = ", ".join(["label int", *(f"`{label}` bigint" for label in evaluation.CONFUSION_LABELS)])
    matrix = tables.read_csv(spark, f"{path}/confusion", schema)
    cells = F.array(*[F.struct(F.lit(c).alias("prediction"), F.col(f"`{c}`").alias("n")) for c in evaluation.CONFUSION_LABELS])
    return matrix.select("label", F.inline(cells))


@query
def p14_experiment_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Every usable page with its part of the published splits, small ones included."""
    split = session.stage(labelling.split_pages(period_texts(spark, sf).drop("text")), "split")
    tiny = labelling.tiny_pages(split).select("page_id", F.lit(True).alias("tiny"))
    return split.join(tiny, "page_id", "left").na.fill(False, ["tiny"])


@query
def e1_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.accuracy(predictions(spark, sf)), "accuracy")


@query
def e2_confusion(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.confusion(predictions(spark, sf))


@query
def e3_class_report(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.class_report(predictions(spark, sf)), "precision", "recall", "f1")


@query
def e4_neighbour_error(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(evaluation.neighbour_error(predictions(spark, sf)), "near_share")
