"""SimHash near duplicates, found by meeting in the middle of Hamming balls.

Two fingerprints differ in at most r bits when they share a variant that is at most r/2
flips from each. All variants of a 64-bit word within two flips are 2,081, too many to
shuffle for every text, so the ball is entered in two steps, each exact. Of r = 4 differing
bits one 32-bit half has at most two: every fingerprint first emits the variants of each
half within half of that, 33 per half, and only fingerprints that meet another in a half
go on. Up to PAIRED that meet are compared, and only links that join them are passed on.
Where more meet, each emits the variants of the whole word within two flips that go with
this half's variant; all that share such a variant lie within four bits of each other, so one
link from each to the smallest of them holds the group together. Either way a group costs no
more links than it has members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagedater.llm.common import picked
from pagedater.llm.components import components
from pagedater.session import stage

RADIUS = 4
SEED = 42
HASHES_AT_ONCE = 1 << 17
#: Most fingerprints that meet in a half and are compared with each other in a task.
PAIRED = 2048


def words_of(text: str | None) -> bytes:
    """A-Z lowered, words of anything but ASCII white space, joined by one space."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Bits that are set in over half of the XXH64 of a text's shingles, repeats included."""
    line = words_of(text)
    if not line:
        return 0
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    count = len(spaces) + 1
    starts = [0, *(spaces + 1).tolist()]
    ends = [*spaces.tolist(), len(line)]
    width = min(shingle, count)
    total, set_bits = count - width + 1, np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, HASHES_AT_ONCE):
        to = min(total, at + HASHES_AT_ONCE)
        hashes = np.fromiter(
            (digest(line[a:b], SEED) for a, b in zip(starts[at:to], ends[at + width - 1 : to + width - 1])),
            np.uint64,
            to - at,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, text_key, fp) of whole texts; null, empty and blank texts have fp 0.

    ``text_key`` is a hash of the text, to tell rows of one id apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text, shingle) for text in batch.column("text").to_pylist()]
            fps = pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())
            columns = [batch.column("doc_id").cast(pa.int64()), batch.column("text_key"), fps]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "fp"])

    keyed = picked(docs, "doc_id", "text").withColumn("text_key", F.xxhash64("text"))
    return keyed.mapInArrow(run, "doc_id long, text_key long, fp long")


def _masks(low: int, high: int, most: int) -> list[int]:
    """Words with at most ``most`` of the bits low to high-1 set, as signed longs."""
    one = [1 << i for i in range(low, high)]
    out = [0]
    if most >= 1:
        out += one
    if most >= 2:
        out += [a | b for i, a in enumerate(one) for b in one[i + 1 :]]
    return [x - (1 << 64) if x >> 63 else x for x in out]


def _flips(masks: list[int]) -> Column:
    return F.array(*(F.lit(x).cast("long") for x in masks))


def joining(fps: np.ndarray) -> list[tuple[int, int]]:
    """Links that join what lies within RADIUS: for each new member one to where it was met."""
    out = []
    # Bits of signed numbers are counted in their absolute value.
    fps = fps.view(np.uint64)
    left = np.arange(len(fps))
    while len(left):
        # Spread from the first that is left, a wave at a time.
        wave, left = left[:1], left[1:]
        while len(wave) and len(left):
            apart = np.bitwise_count(fps[wave][:, None] ^ fps[left][None, :]) <= RADIUS
            met = apart.any(0)
            found = left[met]
            pairs = fps.view(np.int64)
            out += zip(pairs[found].tolist(), pairs[wave[apart[:, met].argmax(0)]].tolist())
            wave, left = found, left[~met]
    return out


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of groups that come sorted by (low, variant)."""

    def done(held: list[int]) -> pa.RecordBatch:
        pairs = joining(np.array(held, np.int64))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (list(zip(*pairs)) or [[], []])], ["a", "b"])

    held: list[int] = []
    now = None
    for batch in batches:
        for low, variant, fp in zip(*(batch.column(c).to_pylist() for c in ("low", "variant", "fp"))):
            if (low, variant) != now and held:
                yield done(held)
                held = []
            now = (low, variant)
            held.append(fp)
    if held:
        yield done(held)


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints (fp long) within RADIUS bits.

    Not all pairs: those that join the same groups, at most one for each variant shared.
    """
    found = []
    for low in (0, 32):
        half = 0xFFFFFFFF << low
        mask = F.lit(half - (1 << 64) if half >> 63 else half).cast("long")
        own = F.col("fp").bitwiseAND(mask)
        met = Window.partitionBy("variant")
        emitted = fps.select("fp", own.alias("own"), F.explode(_flips(_masks(low, low + 32, 1))).alias("flip")).select(
            "fp", "own", F.col("own").bitwiseXOR(F.col("flip")).alias("variant"), (F.col("flip") == 0).alias("same")
        )
        shared = emitted.select(
            "*",
            F.count("*").over(met).alias("n"),
            F.min("own").over(met).alias("own_min"),
            F.max("own").over(met).alias("own_max"),
            F.min("fp").over(met).alias("fp_min"),
        ).filter(
            # Fingerprints of one half meet at that half itself.
            (F.col("n") > 1) & (F.col("same") | (F.col("own_min") != F.col("own_max")))
        )
        found.append(shared.select("fp", "own", "variant", "n", "fp_min", F.lit(low).alias("low")))
    met = stage(found[0].unionByName(found[1]), "met")

    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("fp_min"))) <= RADIUS
    pairs = met.filter((F.col("n") == 2) & (F.col("fp") != F.col("fp_min")) & near)
    out = pairs.select(F.col("fp").alias("a"), F.col("fp_min").alias("b"))
    some = met.filter((F.col("n") > 2) & (F.col("n") <= PAIRED)).select("low", "variant", "fp")
    out = out.unionByName(
        some.repartition("low", "variant").sortWithinPartitions("low", "variant").mapInArrow(_compared, "a long, b long")
    )

    variants = None
    for low in (0, 32):
        other = (32, 64) if low == 0 else (0, 32)
        many = met.filter((F.col("n") > PAIRED) & (F.col("low") == low))
        for flipped, masks in ((False, _masks(*other, 2)), (True, _masks(*other, 1))):
            part = many.filter((F.col("own") != F.col("variant")) == F.lit(flipped)).select(
                "fp",
                F.explode(_flips(masks)).alias("flip"),
                F.col("own").bitwiseXOR(F.col("variant")).bitwiseXOR(F.col("fp")).alias("base"),
            )
            part = part.select("fp", F.col("base").bitwiseXOR(F.col("flip")).alias("variant"))
            variants = part if variants is None else variants.unionByName(part)
    centre = Window.partitionBy("variant")
    stars = (
        variants.withColumn("least", F.min("fp").over(centre))
        .filter(F.col("fp") != F.col("least"))
        .select(F.col("fp").alias("a"), F.col("least").alias("b"))
    )
    return out.unionByName(stars).distinct()


def grouped(prints: DataFrame) -> DataFrame:
    """Add ``root``, the same for all fingerprints (fp) that links join."""
    distinct = stage(prints.select("fp").distinct(), "distinct")
    roots = components(links(distinct)).withColumnRenamed("node", "fp")
    return prints.join(distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "fp")


def near_duplicates(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) of all documents (doc_id, text).

    Repeated rows come back repeated. A null doc_id gets its component, of which it can't
    be the smallest id; a component of nothing but null ids has a null id.
    """
    rows = stage(grouped(stage(fingerprints(docs, shingle), "fingerprints")), "grouped")
    ids = rows.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows.join(ids, "root").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def first_of_each(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The documents with the smallest id of each root of ``rows`` (doc_id, text_key, root)."""
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first")
    kept = rows.groupBy("root").agg(first).select(
        F.col("first.doc_id").alias("_id"), F.col("first.text_key").alias("_key")
    )
    keyed = docs.withColumn("_text_key", F.xxhash64(docs["text"]))
    met = keyed["doc_id"].eqNullSafe(kept["_id"]) & (keyed["_text_key"] == kept["_key"])
    return keyed.join(kept, met, "left_semi").dropDuplicates(["doc_id", "_text_key"]).select(*docs.columns)


def one_of_each(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """One document of each near-duplicate group, with all its columns: the smallest doc_id.

    Null ids come after others; rows with equal id and text count as one.
    """
    return first_of_each(docs, grouped(stage(fingerprints(docs, shingle), "fingerprints")))
