"""Four classifiers over sparse count vectors, fitted by MLlib.

Each ``train`` table has ``features`` and a label column; a fitted ``Classifier``
predicts labels of the same kind (class years, languages).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LinearSVCModel,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRestModel,
)
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session

# Published settings.
MAX_DEPTH = 30
HIDDEN = (100, 100)
SMOOTHING = 1.0
MLP_SEED = 1

MAX_CLASSES = 1_000
# Rows that are projected together.
ROWS = 512
# Each kernel machine that is being fitted holds a copy of its rows in the executors: machines are
# fitted beside each other as long as their copies stay within so many bytes, else one by one.
COPIES_BYTES = 4 << 30


@dataclass
class Classifier:
    """A fitted model with the labels its class numbers stand for."""

    model: Model
    classes: list
    label: str
    projection: "FourierFeatures | None" = None
    #: Of the machines of ``svm``: iterations each, and whether all met the tolerance.
    iterations: list[int] = field(default_factory=list)
    converged: bool = True


def class_list(train: DataFrame, label: str) -> list:
    """Sorted distinct labels; there is one per class, so they fit the driver."""
    rows = train.select(label).distinct().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label!r}")
    return sorted(row[0] for row in rows if row[0] is not None)


def _numbered(df: DataFrame, label: str, classes: list) -> DataFrame:
    """Add ``class``, the dense class number MLlib asks for; unknown labels are left out."""
    known = F.array(*[F.lit(c) for c in classes])
    position = F.array_position(known, F.col(label)) - 1
    return df.withColumn("class", position.cast("double")).filter(F.col("class") >= 0)


def _fit(train: DataFrame, label: str, estimator) -> Classifier:
    classes = class_list(train, label)
    return Classifier(estimator.fit(_numbered(train, label, classes)), classes, label)


def decision_tree(train: DataFrame, label: str = "semicentury", seed: int = 0) -> Classifier:
    """Gini tree. MLlib bins the counts and stops at depth 30, its maximum."""
    return _fit(
        train,
        label,
        DecisionTreeClassifier(labelCol="class", impurity="gini", maxDepth=MAX_DEPTH, seed=seed),
    )


def naive_bayes(train: DataFrame, label: str = "semicentury") -> Classifier:
    """Multinomial naive Bayes, add-one smoothing."""
    return _fit(
        train, label, NaiveBayes(labelCol="class", modelType="multinomial", smoothing=SMOOTHING)
    )


def mlp(
    train: DataFrame, label: str = "semicentury", seed: int = MLP_SEED, max_iter: int = 100
) -> Classifier:
    """Perceptron with two hidden layers of 100.

    MLlib has sigmoid units and L-BFGS where the published run had ReLU and Adam.
    """
    classes = class_list(train, label)
    width = train.select("features").first()["features"].size
    estimator = MultilayerPerceptronClassifier(
        labelCol="class", layers=[width, *HIDDEN, len(classes)], seed=seed, maxIter=max_iter
    )
    return Classifier(estimator.fit(_numbered(train, label, classes)), classes, label)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: neighbouring numbers become unlike ones."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def normal_rows(rows: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Normal numbers, ``size`` to a row, that depend on the row's number and the seed only."""
    cell = rows.astype(np.uint64)[:, None] * np.uint64(2 * size) + np.arange(2 * size, dtype=np.uint64)
    # 53 bits, never 0.
    uniform = ((_mixed(_mixed(cell + np.uint64(1)) ^ _mixed(np.uint64([seed]) + np.uint64(77))) >> np.uint64(11)) + 0.5) / 2**53
    return np.sqrt(-2 * np.log(uniform[:, :size])) * np.cos(2 * np.pi * uniform[:, size:])


@dataclass
class FourierFeatures:
    """Random Fourier features of the RBF kernel (Rahimi and Recht, 2007).

    The weights of a token come from its number and the seed, where they are needed: nothing
    that grows with the vocabulary is broadcast.
    """

    gamma: float
    size: int = 256
    seed: int = 0

    def project(self, indices: list[np.ndarray], counts: list[np.ndarray]) -> np.ndarray:
        """The features of sparse rows: one product for the rows that go together."""
        spread, scale = np.sqrt(2 * self.gamma), np.sqrt(2 / self.size)
        shift = np.random.default_rng(self.seed).uniform(0, 2 * np.pi, self.size)
        lengths = np.array([len(x) for x in indices])
        tokens, place = np.unique(np.concatenate(indices).astype(np.int64), return_inverse=True)
        rows = np.zeros((len(indices), len(tokens)))
        rows[np.repeat(np.arange(len(indices)), lengths), place] = np.concatenate(counts)
        return scale * np.cos(rows @ normal_rows(tokens, self.size, self.seed) * spread + shift)

    def transform(self, df: DataFrame) -> DataFrame:
        @F.pandas_udf("array<double>")
        def project(indices: pd.Series, counts: pd.Series) -> pd.Series:
            parts = [
                self.project(list(indices[at : at + ROWS]), list(counts[at : at + ROWS]))
                for at in range(0, len(indices), ROWS)
            ]
            return pd.Series(list(np.concatenate(parts)) if parts else [])

        sparse = F.unwrap_udt("features")
        projected = project(sparse["indices"], sparse["values"])
        return df.withColumn("features", array_to_vector(projected))


def kernel_scale(train: DataFrame) -> tuple[int, float]:
    """Rows, and ``1 / (width * variance of all cells)``, in one sparse pass."""
    stats = train.select(
        Summarizer.metrics("mean", "normL2", "count").summary(F.col("features")).alias("s")
    ).select("s.*").first()
    width = stats["mean"].size
    mean = float(np.mean(stats["mean"].toArray()))
    square = float(np.sum(stats["normL2"].toArray() ** 2)) / (stats["count"] * width)
    variance = square - mean * mean
    gamma = 1.0 / (width * variance) if variance > 0 else 1.0
    return stats["count"], gamma


def machines_at_once(rows: int, size: int, most: int) -> int:
    """How many machines hold a copy of ``rows`` rows of ``size`` doubles at a time, one at least."""
    return max(1, min(most, COPIES_BYTES // max(1, rows * size * 8)))


def svm(
    train: DataFrame,
    label: str = "semicentury",
    size: int = 256,
    seed: int = 0,
    max_iter: int = 10_000,
    tol: float = 1e-3,
    parallelism: int = 4,
) -> Classifier:
    """RBF-kernel support vector machine, approximated.

    MLlib has no kernel machine: linear machines, one class against the rest, run
    over random Fourier features of the same kernel, with the same weight of errors
    (C = 1) and tolerance. They run until the tolerance is met; ``max_iter`` is for the
    impatient, and ``iterations`` and ``converged`` of the result tell what happened.
    Up to ``parallelism`` machines are fitted at once, as their copies of the rows fit
    ``COPIES_BYTES``; all read one stored table, and the result doesn't depend on it.
    """
    rows, gamma = kernel_scale(train)
    projection = FourierFeatures(gamma, size, seed)
    classes = class_list(train, label)
    numbered = _numbered(train, label, classes).select("class", "features")
    projected = session.stage(projection.transform(numbered), "projected")
    machine = LinearSVC(labelCol="own", maxIter=max_iter, tol=tol, regParam=1.0 / rows, standardization=False)

    @inheritable_thread_target(train.sparkSession)
    def against_the_rest(number: int) -> LinearSVCModel:
        own = F.when(F.col("class") == number, 1.0).otherwise(0.0)
        return machine.fit(projected.select(own.alias("own"), "features"))

    with ThreadPool(machines_at_once(rows, size, parallelism)) as pool:
        model = OneVsRestModel(models=pool.map(against_the_rest, range(len(classes)), chunksize=1))
    iterations = [m.summary().totalIterations for m in model.models]
    return Classifier(model, classes, label, projection, iterations, all(n < max_iter for n in iterations))


def predict(fitted: Classifier, df: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, label, prediction)`` for every row of ``df``."""
    rows = df.select(key, F.col(fitted.label).alias("label"), "features")
    if fitted.projection is not None:
        rows = fitted.projection.transform(rows)
    known = F.array(*[F.lit(c) for c in fitted.classes])
    scored = fitted.model.transform(rows)
    return scored.select(
        key, "label", F.element_at(known, F.col("prediction").cast("int") + 1).alias("prediction")
    )


def save(fitted: Classifier, path: str) -> None:
    """Store a fitted classifier: MLlib's own files, and a table of its classes.

    The kernel machine's features are drawn anew from its seed and are not stored.
    """
    if fitted.projection is not None:
        raise ValueError("a kernel machine has no stored form")
    spark = SparkSession.getActiveSession()
    fitted.model.write().overwrite().save(f"{path}/model")
    rows = [(i, fitted.label, str(c), type(c).__name__) for i, c in enumerate(fitted.classes)]
    spark.createDataFrame(rows, "class int, label string, value string, kind string").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/classes")


def load(spark: SparkSession, path: str, kind: type[Model]) -> Classifier:
    """Read what ``save`` stored; ``kind`` is the class of the model, such as ``NaiveBayesModel``."""
    rows = spark.read.parquet(f"{path}/classes").orderBy("class").collect()
    classes = [int(r["value"]) if r["kind"] == "int" else r["value"] for r in rows]
    return Classifier(kind.load(f"{path}/model"), classes, rows[0]["label"])


def naive_bayes_table(
    features: DataFrame, docs: DataFrame, vocabulary: DataFrame, label: str, smoothing: float = SMOOTHING
) -> DataFrame:
    """Log-likelihoods of multinomial naive Bayes as a table ``(label, token, log_prob)``.

    ``features`` holds ``(token_id, n, label)`` rows of the training documents. A class
    has a row for every vocabulary token, seen or not.
    """
    n_tokens = vocabulary.select(F.count("*")).scalar()
    cells = features.groupBy(label, "token_id").agg(F.sum("n").alias("n"))
    classes = docs.select(F.collect_set(label)).scalar()
    grid = vocabulary.select("token_id", "token", F.explode(classes).alias(label))
    totals = cells.groupBy(label).agg(F.sum("n").alias("total"))
    n = F.coalesce(F.col("n"), F.lit(0))
    total = F.coalesce(F.col("total"), F.lit(0))
    return (
        grid.join(cells, [label, "token_id"], "left")
        .join(totals, label, "left")
        .select(
            label,
            "token",
            F.log((n + smoothing) / (total + smoothing * n_tokens)).alias("log_prob"),
        )
    )
