"""From labelled texts to features, four classifiers and their evaluation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import session
from ..operators import evaluation, models, splits, subwords, tokens
from ..sources import tables

MODELS: dict[str, Callable[..., models.Classifier]] = {
    "decision_tree": models.decision_tree,
    "svm": models.svm,
    "naive_bayes": models.naive_bayes,
    "mlp": models.mlp,
}


def features(
    docs: DataFrame,
    label: str = "semicentury",
    key: str = "page_id",
    min_df: float = tokens.MIN_DF,
    fit_on: str = "train",
    merges: int = 0,
) -> tuple[DataFrame, list[str]]:
    """Split texts 80/20 and count the tokens of a pruned vocabulary.

    Returns ``(key, label, split, features)`` and the vocabulary. The vocabulary is
    learned from the training rows; ``fit_on="all"`` learns it from every row, as the
    published run did. With ``merges`` the tokens are byte-pair tokens of so many merges,
    learned from the same rows, and each text is cut into them once: its counts are stored.
    Else they are words, and texts are read for the tokens that are common in some batch of them,
    and for the vectors.
    """
    split = session.stage(splits.random_split(docs.select(key, label, "text"), key=key), "split")
    fitted = split if fit_on == "all" else split.filter(F.col("split") == "train")
    if merges:
        table = session.stage(subwords.learn_merges(session.stage(subwords.word_counts(fitted), "words"), merges), "merges")
        bags = session.stage(subwords.subword_bags(split, table), "bags")
        learned_from = bags if fit_on == "all" else bags.filter(F.col("split") == "train")
        frequencies = tokens.doc_frequency(learned_from.select(F.explode("bag").alias("pair")).select("pair.token"))
        names = tokens.feature_names(tokens.prune_vocabulary(frequencies, fitted, min_df))
        return tokens.bag_vectors(bags, names).select(key, label, "split", "features"), names
    learned = F.lit(True) if fit_on == "all" else F.col("split") == "train"
    return tokens.common_vectors(split.select(key, label, "split", "text"), learned, min_df)


def run(
    vectors: DataFrame, model: str, label: str = "semicentury", key: str = "page_id", **options
) -> DataFrame:
    """Fit one classifier on ``train`` and predict ``test``."""
    train = vectors.filter(F.col("split") == "train")
    fitted = MODELS[model](train, label, **options)
    return models.predict(fitted, vectors.filter(F.col("split") == "test"), key)


def write_report(predictions: DataFrame, path: str) -> None:
    """The report as CSV files with a header each; confusion rows are named by their class."""
    for name, table in report(predictions).items():
        tables.write_csv(table, f"{path}/{name}")


def report(predictions: DataFrame) -> dict[str, DataFrame]:
    return {
        "accuracy": evaluation.accuracy(predictions),
        "confusion": evaluation.confusion(predictions),
        "class_report": evaluation.class_report(predictions),
    }
