"""Quality by compression: which of two dictionaries, good or bad text, fits a text better.

Two zstandard dictionaries are trained on labelled texts. Each whole text is cut into short
blocks, every block is compressed with both, and the difference of the sizes over their
sum says which it resembles. Block figures of a text (mean and extremes of the difference,
mean and least of the rate) become a score by logistic regression on labelled texts that
the dictionaries have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagedater.llm.common import held_out, learnable, picked, smallest_hashes
from pagedater.session import stage

#: Bound of the fit: so many texts per label for the dictionaries and as many for the
#: calibration, in hash order, of texts up to SAMPLE_BYTES. Scoring has no bounds.
SAMPLE_TEXTS = 1000
SAMPLE_BYTES = 1 << 15
DICTIONARY_BYTES = 1 << 16
BLOCK = 1024
LEVEL = 3
THRESHOLD = 0.7

SCORES = "doc_id long, score double"


def blocks(data: bytes, size: int = BLOCK) -> list[bytes]:
    return [data[i : i + size] for i in range(0, len(data), size)]


@dataclass(frozen=True)
class Dictionaries:
    """The two dictionaries as bytes, so that tasks can be sent them."""

    good: bytes
    bad: bytes

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        out = []
        for data in (self.good, self.bad):
            known = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_AUTO)
            known.precompute_compress(level=LEVEL)
            out.append(
                zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False)
            )
        return out[0], out[1]


def dictionary(texts: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of the texts' blocks; too little to train on becomes the content itself."""
    samples = [b for text in texts for b in blocks(text)]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def figures(data: bytes, good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> np.ndarray:
    """What the regression sees of a text that is not empty."""
    parts = blocks(data)
    g = np.array([len(good.compress(b)) for b in parts], float)
    b = np.array([len(bad.compress(b)) for b in parts], float)
    n = np.array([len(p) for p in parts], float)
    diff, rate = (b - g) / (b + g), np.minimum(g, b) / n
    mean = float((b.sum() - g.sum()) / (b.sum() + g.sum()))
    # A short last block compresses badly; it counts in the means by its size only.
    whole = n >= BLOCK / 2 if (n >= BLOCK / 2).any() else n > 0
    least, most = diff[whole].min(), diff[whole].max()
    overall, low = np.minimum(g, b).sum() / n.sum(), rate[whole].min()
    return np.array([mean, least, most, overall, low, min(overall, 1.5) ** 2, low**2, np.log(n.sum())])


@dataclass(frozen=True)
class Model:
    dictionaries: Dictionaries
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Scores of whole texts; an empty or null text gets the share of good labels."""
        good, bad = self.dictionaries.compressors()
        out = np.full(len(texts), self.prior)
        full = [(i, t.encode("utf-8", "surrogatepass")) for i, t in enumerate(texts) if t]
        if full:
            x = (np.array([figures(data, good, bad) for _, data in full]) - self.centre) / self.scale
            z = self.weights[0] + x @ self.weights[1:]
            out[[i for i, _ in full]] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Intercept and weights by Newton's method with a small ridge."""
    x1 = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x1.shape[1])
    keep = np.eye(len(w)) * ridge
    keep[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        step = np.linalg.solve((x1 * (weight * p * (1 - p))[:, None]).T @ x1 + keep, x1.T @ (weight * (y - p)) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, texts: int = SAMPLE_TEXTS, text_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on the documents (doc_id, text) that ``labels`` (doc_id, quality) marks.

    Held-out ids are not learned from. A document with labels of both kinds counts as bad;
    a null label counts as none. The sample is at most 2 x ``texts`` per label in hash order
    of the whole input; half of it makes the dictionaries, the other half the calibration,
    weighted to the labels' true shares. With one label or none, every score is the share of
    good labels (a half where there is none).
    """
    marks = (
        picked(labels, "doc_id", "quality")
        .filter(learnable("doc_id", 4, 2) & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    # Sizes meet the labels, not texts.
    sizes = picked(docs, "doc_id", "text").select("doc_id", F.octet_length("text").alias("size"))
    usable = stage(sizes.filter(F.col("size") > 0).join(marks, "doc_id").select("doc_id", "quality", "size"), "labelled")
    shares = {row["quality"]: row["n"] for row in usable.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    total = sum(shares.values())
    prior = shares.get(1, 0) / total if total else 0.5
    short = usable.filter(F.col("size") <= text_bytes).select("doc_id", "quality").distinct()
    sample = smallest_hashes(short, "quality", F.col("doc_id"), 2 * texts)
    # At most 4 x texts ids: a bounded broadcast, whatever the input.
    rows = (
        picked(docs, "doc_id", "text")
        .filter(F.octet_length("text").between(1, text_bytes))
        .join(F.broadcast(sample), "doc_id")
        .select("quality", "text", F.xxhash64("doc_id").alias("hash"))
        .limit(8 * texts)
        .collect()
    )
    halves: dict[tuple[int, int], list[bytes]] = {}
    for label in (0, 1):
        own = sorted((row["hash"], row["text"]) for row in rows if row["quality"] == label)
        data = [text.encode("utf-8", "surrogatepass") for _, text in own]
        halves[label, 0], halves[label, 1] = data[0::2], data[1::2]
    made = Dictionaries(dictionary(halves[1, 0]), dictionary(halves[0, 0]))
    width = 8
    flat = Model(made, np.zeros(width), np.ones(width), np.r_[np.log((prior + 1e-3) / (1 - prior + 1e-3)), np.zeros(width)], prior)
    if not (halves[0, 1] and halves[1, 1]):
        return flat
    good, bad = made.compressors()
    x = np.array([figures(t, good, bad) for label in (0, 1) for t in halves[label, 1]])
    y = np.repeat([0.0, 1.0], [len(halves[0, 1]), len(halves[1, 1])])
    weight = np.where(y == 1, shares[1] / len(halves[1, 1]), shares[0] / len(halves[0, 1]))
    weight *= len(y) / weight.sum()
    centre, scale = x.mean(0), x.std(0) + 1e-9
    return Model(made, centre, scale, logistic((x - centre) / scale, y, weight), prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every whole text; rows, repeated ones too, come back one to one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(model.scores(batch.column("text").to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), found], ["doc_id", "score"])

    return picked(docs, "doc_id", "text").mapInArrow(run, SCORES)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``threshold`` on) per document."""
    scores = score(docs, fit(docs, labels))
    return scores.select(
        "doc_id",
        held_out("doc_id", 4, 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches ``threshold``, with all their columns.

    The score is joined to nothing: it is computed beside the row it decides on.
    """
    model = fit(docs, labels)

    @F.pandas_udf("double")
    def scored(texts):
        import pandas as pd

        return pd.Series(model.scores([t if isinstance(t, str) else None for t in texts]))

    return docs.filter(scored("text") >= threshold)
