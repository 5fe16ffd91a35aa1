"""Language identification by error-correcting output codes.

Every language has a codeword; a binary classifier per bit, over hashed character n-grams,
tells the languages with that bit set from the others. A text gets a margin per bit, and
the codeword with the smallest loss wins, where the loss of each bit is weighted by how well
its classifier did on texts that it was not fitted to. The same margins set how far a loss
counts in the score. Two codewords at nearly the same loss flag an ambiguous text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagedater.llm.common import held_out, learnable, picked, smallest_hashes

#: Bound of the fit: so many texts over all languages, the same number of each (5 at least),
#: in hash order, of texts up to SAMPLE_BYTES. Prediction has no bounds.
SAMPLE_TEXTS = 1200
SAMPLE_BYTES = 1 << 15
#: Languages are few; more than this many values of ``lang`` is an error, not a cut.
MOST_LANGUAGES = 1000
BUCKETS = 1 << 14
GRAMS = (1, 2, 3, 4)
AMBIGUOUS = 0.1
FOLDS = 5
#: Factors of the losses in the score; the one under which texts left out are likeliest is taken.
SCALES = (0.25, 0.5, 1.0, 2.0, 4.0, 8.0)
UNKNOWN = "und"

PREDICTIONS = "doc_id long, lang_pred string, score double, ambiguous boolean"


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n words of -1 and 1: all splits in two of up to 6 languages, else random balanced bits."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 6:
        bits = [[(s >> i) & 1 for i in range(n)] for s in range(1, 2 ** (n - 1))]
        return np.array(bits).T * 2.0 - 1
    rng = np.random.default_rng(seed)
    half = np.r_[np.ones(n // 2), -np.ones(n - n // 2)]
    return np.array([rng.permutation(half) for _ in range(max(15, int(10 * np.log2(n))))]).T


def counts(text: str) -> np.ndarray:
    """Relative frequencies of hashed n-grams of the lower-cased text's UTF-8 bytes, all of it."""
    b = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    out = np.zeros(BUCKETS, np.float32)
    for n in GRAMS:
        if len(b) < n:
            break
        key = np.zeros(len(b) - n + 1, np.uint32)
        for i in range(n):
            key = (key << np.uint32(8)) | b[i : len(b) - n + 1 + i]
        key = (key + np.uint32(n)) * np.uint32(2654435761)
        out += np.bincount(key >> np.uint32(18), minlength=BUCKETS).astype(np.float32) / len(key)
    return out


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    bit_weight: np.ndarray
    scale: float = 1.0

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, confidence, ambiguous) per text; texts without a letter are unknown."""
        out = []
        for text in texts:
            if not self.languages or not text or not any(map(str.isalpha, text)):
                out.append((UNKNOWN, 0.0, False))
                continue
            margin = np.clip(np.sqrt(counts(text)) @ self.weights + self.bias, -3, 3)
            share = shares(margin[None, :], self.code, self.bit_weight, self.scale)[0]
            best = int(share.argmax())
            rival = np.sort(share)[-2] if len(share) > 1 else 0.0
            out.append((self.languages[best], float(share[best]), bool(share[best] - rival < AMBIGUOUS)))
        return out


def shares(margin: np.ndarray, code: np.ndarray, bit_weight: np.ndarray, scale: float) -> np.ndarray:
    """Shares of the codewords per row of margins, by their weighted logistic losses."""
    loss = (np.log1p(np.exp(-code[None] * margin[:, None, :])) * bit_weight).sum(2) * scale
    share = np.exp(loss.min(1, keepdims=True) - loss)
    return share / share.sum(1, keepdims=True)


def ridge_fit(x: np.ndarray, label: np.ndarray, code: np.ndarray, ridge: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases of all bits. Each language weighs the same, however many texts it has.

    Rows are far fewer than buckets, so the regression is solved in the space of rows.
    """
    weight = np.sqrt(1.0 / np.bincount(label)[label])
    weight *= np.sqrt(len(label)) / np.linalg.norm(weight)
    mean = np.average(x, axis=0, weights=weight**2)
    xc = ((x - mean) * weight[:, None]).astype(np.float64)
    target = code[label]
    offset = np.average(target, axis=0, weights=weight**2)
    gram = xc @ xc.T
    scale = ridge * np.trace(gram) / len(gram) * 0.01 + 1e-9
    alpha = np.linalg.solve(gram + scale * np.eye(len(gram)), (target - offset) * weight[:, None])
    w = xc.T @ alpha
    return w, offset - mean @ w


def train(samples: list[tuple[str, str]], ridge: float = 1.0) -> Model:
    """Fit the bit classifiers to (language, text): ridge regression on the codewords' bits.

    Margins of texts left out, fold by fold, give the bits' weights and the scale of the
    score; equal texts are in one fold.
    """
    languages = sorted({lang for lang, _ in samples})
    code = codewords(len(languages))
    if not samples:
        return Model([], code, np.zeros((BUCKETS, 1), np.float32), np.zeros(1), np.ones(1))
    at = {lang: i for i, lang in enumerate(languages)}
    label = np.array([at[lang] for lang, _ in samples])
    x = np.sqrt(np.array([counts(text) for _, text in samples], np.float32))
    w, bias = ridge_fit(x, label, code, ridge)
    fold = np.array([zlib.crc32(text.encode("utf-8", "surrogatepass")) % FOLDS for _, text in samples])
    margin = np.full((len(label), code.shape[1]), np.nan)
    for k in range(FOLDS):
        out, rest = fold == k, fold != k
        if out.any() and rest.any():
            fold_w, fold_bias = ridge_fit(x[rest], label[rest], code, ridge)
            margin[out] = x[out] @ fold_w + fold_bias
    seen = ~np.isnan(margin).any(1)
    if not seen.any():
        return Model(languages, code, w.astype(np.float32), bias, np.ones(code.shape[1]))
    margin, truth = np.clip(margin[seen], -3, 3), label[seen]
    # A bit's error is the mean chance its margins give to the wrong side; its weight the odds.
    error = 1 / (1 + np.exp(2 * code[truth] * margin))
    miss = np.clip(error.mean(0), 1e-3, 0.5)
    bit_weight = np.log((1 - miss) / miss) + 1e-3
    bit_weight /= bit_weight.mean()
    rows = np.arange(len(truth))
    likely = [np.log(shares(margin, code, bit_weight, c)[rows, truth] + 1e-12).mean() for c in SCALES]
    return Model(languages, code, w.astype(np.float32), bias, bit_weight, SCALES[int(np.argmax(likely))])


def fit(docs: DataFrame, texts: int = SAMPLE_TEXTS, text_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on documents (doc_id, text, lang) that may be learned from, lang not null."""
    usable = picked(docs, "doc_id", "text", "lang").filter(
        learnable("doc_id", 4, 2) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    languages = [r["lang"] for r in usable.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect()]
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    each = max(5, texts // max(1, len(languages)))
    short = usable.filter(F.octet_length("text") <= text_bytes)
    rows = smallest_hashes(short, "lang", F.struct("doc_id", "text"), each).select("lang", "text").collect()
    return train(sorted((row["lang"], row["text"]) for row in rows))


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous for every whole text.

    Null texts and texts without a letter are ``und`` with score 0.
    """
    model = model or fit(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(zip(*model.predict(batch.column("text").to_pylist()))) or [[], [], []]
            kinds = (pa.string(), pa.float64(), pa.bool_())
            columns = [pa.array(c, k) for c, k in zip(found, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *columns], ["doc_id", "lang_pred", "score", "ambiguous"]
            )

    found = picked(docs, "doc_id", "text").mapInArrow(run, PREDICTIONS)
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", "ambiguous")
