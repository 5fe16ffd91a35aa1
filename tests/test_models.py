"""Classifiers on the languages of the documents: well above the majority class."""

import math
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import GATE
from pagedater import session
from pagedater.operators import evaluation, models, tokens
from pagedater.plans import experiment
from pagedater.registry import queries


@pytest.fixture(scope="module")
def vectors(spark):
    return experiment.features(queries.texts(spark, GATE), label="lang", key="doc_id")[0]


@pytest.fixture(scope="module")
def majority(vectors):
    sizes = vectors.filter("split = 'test'").groupBy("lang").count()
    return sizes.agg(F.max("count") / F.sum("count")).first()[0]


@pytest.mark.parametrize(
    "model, options",
    [("decision_tree", {}), ("svm", {}), ("naive_bayes", {}), ("mlp", {"max_iter": 40})],
)
def test_better_than_the_majority(vectors, majority, model, options):
    predictions = experiment.run(vectors, model, "lang", "doc_id", **options)
    assert predictions.columns == ["doc_id", "label", "prediction"]
    assert predictions.count() == vectors.filter("split = 'test'").count()
    assert evaluation.accuracy(predictions).first()[0] > majority + 0.15


def test_vocabulary_comes_from_the_training_rows_unless_asked(spark):
    docs = spark.createDataFrame(
        [(i, "fr", "a b" if i % 2 else "a") for i in range(40)], "page_id long, semicentury string, text string"
    )
    test_only = experiment.splits.random_split(docs).filter("split = 'test'").select("page_id")
    docs = docs.join(test_only.withColumn("held", F.lit(True)), "page_id", "left").withColumn(
        "text", F.when(F.col("held"), F.lit("unseen")).otherwise(F.col("text"))
    )
    assert "unseen" not in experiment.features(docs)[1]
    assert "unseen" in experiment.features(docs, fit_on="all")[1]


def test_naive_bayes_table_is_the_library_model(spark):
    df = tokens.word_tokens(queries.texts(spark, GATE))
    bag = session.stage(tokens.bag_of_words(df), "bag")
    vocabulary = session.stage(tokens.prune_vocabulary(tokens.doc_frequency(bag), df), "vocabulary")
    docs = df.select("doc_id", "lang", "tokens")
    features = tokens.feature_table(docs, vocabulary)
    table = models.naive_bayes_table(features, docs, vocabulary, "lang").collect()
    names = tokens.feature_names(vocabulary)
    fitted = models.naive_bayes(tokens.vectorise(df, names), "lang")
    theta = fitted.model.theta.toArray()
    assert len(table) == theta.size
    for row in table:
        ours = theta[fitted.classes.index(row.lang), names.index(row.token)]
        assert math.isclose(row.log_prob, ours, rel_tol=1e-9)


def test_predictions_keep_the_labels(spark):
    rows = [(i, 1500 + 50 * (i % 3), "abc"[i % 3] * 1) for i in range(60)]
    df = tokens.word_tokens(spark.createDataFrame(rows, "page_id long, semicentury int, text string"))
    vectors = tokens.vectorise(df, ["a", "b", "c"])
    got = models.predict(models.naive_bayes(vectors), vectors, "page_id").collect()
    assert all(r.label == r.prediction for r in got)


def test_too_many_classes_are_refused(spark, monkeypatch):
    monkeypatch.setattr(models, "MAX_CLASSES", 2)
    df = spark.createDataFrame([(1,), (2,), (3,)], "semicentury int")
    with pytest.raises(ValueError):
        models.class_list(df, "semicentury")


@pytest.mark.parametrize("model", ["decision_tree", "svm", "naive_bayes", "mlp"])
def test_predictions_on_rows_of_known_classes(spark, model):
    """Texts of three periods with words of their own: every test row gets its period."""
    words = {1700: "estoit avoit", 1800: "etait avait", 1900: "est a"}
    rows = [(i, label, f"{text} le la {text} w{i % 5}") for i, (label, text) in enumerate(list(words.items()) * 30)]
    docs = spark.createDataFrame(rows, "page_id long, semicentury int, text string")
    vectors = experiment.features(docs)[0]
    found = experiment.run(vectors, model).collect()
    assert len(found) == 18 and all(r["label"] == r["prediction"] for r in found)


def test_kernel_machine_converges_and_needs_no_weights(spark, vectors):
    fitted = models.svm(vectors.filter("split = 'train'"), "lang", size=64)
    assert fitted.converged and len(fitted.iterations) == len(fitted.classes)
    stopped = models.svm(vectors.filter("split = 'train'"), "lang", size=64, max_iter=2)
    assert not stopped.converged
    with pytest.raises(ValueError):
        models.save(fitted, "nowhere")


def test_machines_beyond_the_bound_are_fitted_one_by_one(spark, monkeypatch):
    """No more copies of the rows at a time than fit, none besides the machines' own, and the same machines."""
    draw = np.random.default_rng(4)
    rows = [(i, "abc"[i % 3], " ".join(draw.choice(["x", "y", "z", "abc"[i % 3]], 6))) for i in range(120)]
    df = tokens.word_tokens(spark.createDataFrame(rows, "page_id long, semicentury string, text string"))
    train = session.stage(tokens.vectorise(df, ["a", "b", "c", "x", "y", "z"]), "train")
    fit, lock, running, most, cached = models.LinearSVC.fit, threading.Lock(), [0], [], []

    def watched(self, dataset, *params):
        with lock:
            running[0] += 1
            most.append(running[0])
            cached.append(dataset.storageLevel.useMemory)
        try:
            return fit(self, dataset, *params)
        finally:
            with lock:
                running[0] -= 1

    monkeypatch.setattr(models.LinearSVC, "fit", watched)
    beside = models.svm(train, size=16)
    assert len(most) == 3 and not any(cached)
    most.clear()
    assert models.machines_at_once(10**7, 256, 4) == 1 and models.machines_at_once(10, 256, 4) == 4
    monkeypatch.setattr(models, "COPIES_BYTES", 120 * 16 * 8)
    alone = models.svm(train, size=16)
    assert most == [1, 1, 1] and not any(cached)
    assert alone.iterations == beside.iterations
    for one, other in zip(alone.model.models, beside.model.models):
        assert np.allclose(one.coefficients.toArray(), other.coefficients.toArray(), rtol=1e-6)


def test_projection_approximates_the_kernel():
    draw = np.random.default_rng(1)
    dense = draw.integers(0, 3, (40, 30)).astype(float)
    places = [np.flatnonzero(row) for row in dense]
    features = models.FourierFeatures(gamma=0.02, size=4096)
    projected = features.project(places, [row[p] for row, p in zip(dense, places)])
    kernel = np.exp(-0.02 * ((dense[:, None] - dense[None]) ** 2).sum(2))
    assert np.abs(projected @ projected.T - kernel).max() < 0.1
    one = features.project(places[:1], [dense[0][places[0]]])
    assert np.allclose(one, projected[:1])
    draws = models.normal_rows(np.arange(2000), 50, 3)
    assert abs(draws.mean()) < 0.02 and abs(draws.std() - 1) < 0.02


def test_a_stored_model_predicts_alike(spark, scratch):
    rows = [(i, 1500 + 50 * (i % 3), "abc"[i % 3]) for i in range(60)]
    df = tokens.word_tokens(spark.createDataFrame(rows, "page_id long, semicentury int, text string"))
    vectors = tokens.vectorise(df, ["a", "b", "c"])
    fitted = models.naive_bayes(vectors)
    models.save(fitted, scratch + "/model")
    again = models.load(spark, scratch + "/model", type(fitted.model))
    assert again.classes == fitted.classes and again.label == "semicentury"
    assert sorted(models.predict(again, vectors, "page_id").collect()) == sorted(models.predict(fitted, vectors, "page_id").collect())


def test_subword_features_are_learned_from_training_rows(spark):
    rows = [(i, 1800, "abab abab" if i % 4 else "abab xy") for i in range(60)]
    docs = spark.createDataFrame(rows, "page_id long, semicentury int, text string")
    names = experiment.features(docs, merges=2)[1]
    assert "abab" in names and "ab" not in names


def test_reports_are_stored(spark, scratch):
    found = spark.createDataFrame([(1, 1800, 1800), (2, 1850, 1800)], "page_id long, label int, prediction int")
    experiment.write_report(found, scratch + "/reports")
    matrix = spark.read.csv(scratch + "/reports/confusion", header=True).filter("label = 1850").first()
    assert matrix["1800"] == "1" and matrix["1850"] == "0"
