"""Word tokens, vocabularies and sparse count features."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, VectorSlicer
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .. import session
from .numbering import numbered

# White space in the Unicode sense, spelled out so that engines agree.
SPACE = r"\t-\r\x1c-\x1f\x{85}\p{Z}"
# A token is a run of anything but white space and . ; ,
WORD = rf"[^{SPACE}.;,]+"
MIN_DF = 0.05

# A vocabulary within this many tokens goes to the driver and to every executor.
# A share of min_df bounds it: a document holds w distinct tokens on average, so at
# most w / min_df tokens reach the share, however many documents there are.
MAX_COLUMNS = 1_000_000
# Texts that are cut into words together.
TEXTS = 1_000


def word_tokens(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``tokens``, in order, case kept."""
    return df.withColumn("tokens", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression of ``value`` that works it out once, however often it is used inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def counted_tokens(df: DataFrame) -> DataFrame:
    """Add ``bag``, the distinct tokens of the row, sorted, each with its count. No shuffle.

    Sorted tokens make runs; a token's count is the distance between the ends of two runs.
    """

    def pairs(tokens: Column) -> Column:
        ends = F.filter(
            F.sequence(F.lit(1), F.size(tokens)),
            lambda i: ~F.get(tokens, i - 1).eqNullSafe(F.get(tokens, i)),
        )
        return _once(
            F.when(F.size(tokens) > 0, ends).otherwise(F.array().cast("array<int>")),
            lambda ends: F.transform(
                ends,
                lambda end, i: F.struct(
                    F.get(tokens, end - 1).alias("token"),
                    (end - F.coalesce(F.get(ends, i - 1), F.lit(0))).cast("long").alias("n"),
                ),
            ),
        )

    listed = F.coalesce("tokens", F.array().cast("array<string>"))
    return df.withColumn("bag", _once(F.array_sort(listed), pairs))


def bag_of_words(df: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Token counts of every row, ``(doc, token, n)``, from a ``tokens`` column. No shuffle."""
    counted = counted_tokens(df.select(doc, "tokens"))
    return counted.select(doc, F.explode("bag").alias("pair")).select(doc, "pair.token", "pair.n")


def doc_frequency(df: DataFrame) -> DataFrame:
    """Documents per token, from a ``tokens`` column or from a bag of words.

    From tokens, repeats are dropped inside the row, so no (document, token) pair is
    ever shuffled: partial counts per token are.
    """
    if "tokens" in df.columns:
        df = df.select(F.explode(F.array_distinct("tokens")).alias("token"))
    return df.groupBy("token").agg(F.count("*").alias("df"))


def prune_vocabulary(frequencies: DataFrame, docs: DataFrame, min_df: float = MIN_DF) -> DataFrame:
    """Keep tokens found in at least ``min_df`` of ``docs``; number them by sort order.

    The share is inclusive. Numbers come from a range sort and counts by part, so no task
    sees the whole vocabulary, also where ``min_df`` is 0.
    """
    n_docs = docs.select(F.count("*")).scalar()
    kept = frequencies.filter(F.col("df") >= F.lit(float(min_df)) * n_docs)
    return numbered(kept, "token_id", "token").withColumn("token_id", F.col("token_id").cast("int"))


def feature_names(vocabulary: DataFrame) -> list[str]:
    """Tokens in column order, on the driver; refused beyond ``MAX_COLUMNS``."""
    rows = vocabulary.select("token_id", "token").limit(MAX_COLUMNS + 1).collect()
    if len(rows) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} tokens: raise min_df")
    return [row["token"] for row in sorted(rows)]


def feature_table(rows: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Counts of vocabulary tokens beside the columns of ``rows`` (key, label, split) in one table.

    ``rows`` has ``tokens``, which are counted in the row. ``vocabulary`` should be staged: when
    it is within the bound of a broadcast, only its tokens are counted, and nothing is shuffled.
    """
    kept = [c for c in rows.columns if c not in ("tokens", "text")]
    known = vocabulary.select("token", "token_id")
    if session.fits_broadcast(known):
        return _known_counts(rows.select(*kept, "tokens"), known.filter("token is not null"))
    pairs = counted_tokens(rows).select(*kept, F.explode("bag").alias("pair")).select(*kept, "pair.token", "pair.n")
    return pairs.join(known, "token").select(*kept, "token_id", "n")


def _known_counts(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Counts of the tokens of ``known`` in place of ``tokens``, by vectors made in the row."""
    kept = [c for c in rows.columns if c != "tokens"]
    listed = [(row["token"], row["token_id"]) for row in known.collect()]
    places = {token: at for at, token in enumerate(dict.fromkeys(token for token, _ in listed))}
    if not places:
        nothing = [F.lit(None).cast(known.schema["token_id"].dataType).alias("token_id"), F.lit(None).cast("long").alias("n")]
        return rows.limit(0).select(*kept, *nothing)
    filled = rows.withColumn("tokens", F.coalesce("tokens", F.array().cast("array<string>")))
    sparse = F.unwrap_udt("features")
    pairs = F.arrays_zip(sparse["indices"].alias("at"), sparse["values"].alias("n"))
    counted = vectorise(filled, list(places)).select(*kept, F.explode(pairs).alias("pair"))
    schema = StructType([StructField("at", IntegerType()), known.schema["token_id"]])
    ids = rows.sparkSession.createDataFrame([(places[token], number) for token, number in listed], schema)
    return counted.join(F.broadcast(ids), counted["pair.at"] == ids["at"]).select(
        *kept, ids["token_id"], F.col("pair.n").cast("long").alias("n")
    )


def wide_features(bag: DataFrame, names: list[str], doc: str = "doc_id") -> DataFrame:
    """One column per token, for small vocabularies; missing counts are 0."""
    kept = bag.filter(F.col("token").isin(names))
    return kept.groupBy(doc).pivot("token", names).agg(F.first("n")).na.fill(0)


def vectorise(df: DataFrame, names: list[str]) -> DataFrame:
    """Add ``features``, sparse count vectors, from a ``tokens`` column. No shuffle."""
    model = CountVectorizerModel.from_vocabulary(names, inputCol="tokens", outputCol="features")
    return model.transform(df)


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The words of ``word_tokens``: the number of each one's text, its place in a dictionary, the dictionary."""
    listed = pc.split_pattern_regex(texts, f"[{SPACE}.;,]+")
    of = np.repeat(np.arange(len(texts)), listed.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    coded = listed.flatten().dictionary_encode()
    place = coded.indices.to_numpy()
    # What stands before a first and after a last sign between words is empty.
    full = place != pc.index(coded.dictionary, "").as_py()
    return of[full], place[full].astype(np.int64), coded.dictionary


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of some ``TEXTS`` rows, alike in size."""
    for batch in batches:
        cuts = np.linspace(0, batch.num_rows, max(1, batch.num_rows // TEXTS) + 1).astype(int).tolist()
        for first, last in zip(cuts, cuts[1:]):
            yield batch.slice(first, last - first)


def common_tokens(df: DataFrame, min_df: float = MIN_DF, text: str = "text") -> DataFrame:
    """Tokens that may be in a share ``min_df`` of the rows: those that are in that share of some batch of them.

    A token that falls short of the share in every batch falls short of it in all, so none is
    missed, and of a batch only the tokens that are common there leave the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[str] = set()
        for batch in _parts(batches):
            of, place, words = _words(batch.column(0))
            n = batch.num_rows
            # Rounding must not lose a token at the bound.
            least = min_df * n * (1 - 1e-9)
            often = np.bincount(place, minlength=len(words)) >= least
            cells = np.unique((place * n + of)[often[place]])
            rows = np.bincount(cells // max(n, 1), minlength=len(words))
            found.update(words.take(np.flatnonzero((rows > 0) & (rows >= least))).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string())], ["token"])

    return df.select(text).mapInArrow(run, "token string").distinct()


def count_vectors(df: DataFrame, names: list[str], text: str = "text") -> DataFrame:
    """``features`` in the place of ``text``: the vectors that ``vectorise`` makes of its words. No shuffle, staged."""
    kept = [c for c in df.columns if c != text]
    known = df.sparkSession.sparkContext.broadcast(names)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = pa.array(known.value, pa.string())
        size = len(listed)
        for batch in _parts(batches):
            of, place, words = _words(batch.column(len(kept)))
            column = pc.index_in(words, listed).fill_null(-1).to_numpy()[place].astype(np.int64)
            cells, counts = np.unique(of[column >= 0] * size + column[column >= 0], return_counts=True)
            yield _with_vectors(batch, cells // max(size, 1), cells % max(size, 1), counts, size)

    return _staged_vectors(df.select(*kept, text), kept, apply)


def common_vectors(
    df: DataFrame, learned: Column, min_df: float = MIN_DF, text: str = "text"
) -> tuple[DataFrame, list[str]]:
    """``features`` in the place of ``text``, and the tokens that stand for their columns, in sort order.

    The tokens are those found in at least a share ``min_df`` of the rows that ``learned`` picks, inclusive:
    what ``prune_vocabulary`` keeps. Vectors of all tokens that may reach the share are made first; how
    many rows hold each is read off them, and the columns of the others are cut out.
    """
    fitted = df.filter(learned)
    maybe = common_tokens(fitted, min_df, text).limit(MAX_COLUMNS + 1).collect()
    if len(maybe) > MAX_COLUMNS:
        names = feature_names(prune_vocabulary(doc_frequency(word_tokens(fitted, text)), fitted, min_df))
        return count_vectors(df, names, text), names
    # By bytes, as Spark sorts.
    names = sorted((row["token"] for row in maybe), key=str.encode)
    vectors = count_vectors(df, names, text)
    held = vectors.filter(learned).select(F.unwrap_udt("features")["indices"].alias("at"))
    least = float(min_df) * held.count()
    frequencies = held.select(F.explode("at").alias("at")).groupBy("at").agg(F.count("*").alias("df"))
    kept = sorted(row["at"] for row in frequencies.filter(F.col("df") >= F.lit(least)).collect())
    if len(kept) < len(names):
        names = [names[at] for at in kept]
        vectors = _sliced(vectors, kept) if kept else count_vectors(df, names, text)
    return vectors, names


def _sliced(vectors: DataFrame, kept: list[int]) -> DataFrame:
    """Only some columns of ``features``."""
    slicer = VectorSlicer(inputCol="features", outputCol="_kept", indices=kept)
    return slicer.transform(vectors).select(
        *[F.col("_kept").alias(c) if c == "features" else c for c in vectors.columns]
    )


def bag_vectors(df: DataFrame, names: list[str]) -> DataFrame:
    """``features`` in the place of ``bag``: the vectors that ``vectorise`` makes. No shuffle, staged.

    A sparse vector is stored as a struct of its kind (0), size, indices and values.
    """
    known = df.sparkSession.sparkContext.broadcast({name: i for i, name in enumerate(names)})
    kept = [c for c in df.columns if c != "bag"]
    size = len(names)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = batch.column(len(kept))
            sizes = bags.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            tokens, counts = bags.flatten().flatten()
            coded = tokens.dictionary_encode()
            columns = np.array([known.value.get(t, -1) for t in coded.dictionary.to_pylist()], np.int32)
            column, row = columns[coded.indices.to_numpy()], np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((column, row))
            order = order[column[order] >= 0]
            yield _with_vectors(batch, row[order], column[order], counts.to_numpy()[order], size)

    return _staged_vectors(df.select(*kept, "bag"), kept, apply)


def _with_vectors(batch: pa.RecordBatch, row: np.ndarray, column: np.ndarray, counts: np.ndarray, size: int) -> pa.RecordBatch:
    """Sparse vectors, from their cells by row and column, in the place of a batch's last column."""
    n = batch.num_rows
    ends = pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32())
    parts = [
        pa.array(np.zeros(n, np.int8)),
        pa.array(np.full(n, size, np.int32)),
        pa.ListArray.from_arrays(ends, pa.array(column.astype(np.int32))),
        pa.ListArray.from_arrays(ends, pa.array(counts.astype(float))),
    ]
    vectors = pa.StructArray.from_arrays(parts, ["type", "size", "indices", "values"])
    return pa.RecordBatch.from_arrays([*batch.columns[:-1], vectors], names=[*batch.schema.names[:-1], "features"])


def _staged_vectors(
    df: DataFrame, kept: list[str], apply: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
) -> DataFrame:
    plain = df.select(*kept, F.lit(None).cast(VectorUDT().sqlType()).alias("features")).schema
    staged = df.select(*kept).schema.add("features", VectorUDT())
    return session.stage(df.mapInArrow(apply, plain), "vectors", staged)
