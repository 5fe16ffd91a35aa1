"""Removal of long byte strings that start in more than one place, by suffix sorting.

A byte goes when a string of ``length`` bytes covers it that starts anywhere else too. Texts
are UTF-8 bytes; matches never cross documents. No text is sorted whole: starts are first
sifted, and every step only drops or settles starts whose answer is certain.

1. Each start has an anchor, the place of the least hash among the grams that follow it, so
   equal strings have their anchors at equal distance. Starts that share an anchor form one
   row: the anchor's core (bytes that all its strings hold) and its context (bytes that they
   cover), as hashes. Rows whose core is nowhere else are out.
2. Equal contexts settle all their starts: twice the same is a repeat.
3. A core with several contexts is cut into strips of STRIP neighbouring starts. The strings
   of a strip share all bytes but STRIP - 1 on either side, so a strip is written as the few
   bytes left of its middle, one symbol for the middle, and the few bytes right of it. Equal
   strips are counted together.
4. Strips with the same middle are joined to an integer text and its suffixes are sorted by
   grouping (see ``grouping``). In suffix order equal strings are neighbours.

A middle with more strips than SORTED has its starts counted by value instead, in shuffled
groups: exact as well, and no task ever holds a whole hot group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagedater.llm.common import picked
from pagedater.llm.grouping import suffix_array
from pagedater.session import stage

LENGTH = 400
#: Starts that look for an anchor together; a power of two.
REACH = 256
GRAM = 8
STRIP = 16
#: Most different strips of a middle that one task sorts, and symbols sorted at a time.
SORTED = 2048
SYMBOLS = 40_000
#: Starts whose anchors are sought at a time in a long text.
STARTS = 1 << 18

ANCHORS = "text_key long, size long, core long, ctx binary, at int, lo int, hi int"
STRIPS = "ctx binary, strip int, middle binary, left binary, right binary, n long"
MASKS = "middle binary, left binary, right binary, mask int"
OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def anchors(data: bytes, length: int = LENGTH) -> Iterator[tuple[int, int, int]]:
    """(anchor, first start, last start) of runs of starts with the same anchor."""
    n = len(data)
    for begin in range(0, n - length + 1, STARTS):
        end = min(n - length + 1, begin + STARTS)
        grams = end - begin + REACH - 1
        value = np.ndarray((grams,), "<u8", data, begin, (1,))
        with np.errstate(over="ignore"):
            key = ((value ^ (value >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32) << np.uint64(32)
        key |= np.uint64(0xFFFFFFFF) - np.arange(grams, dtype=np.uint64)
        width = 1
        while width < REACH:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        at = 0xFFFFFFFF - (key & np.uint64(0xFFFFFFFF)).astype(np.int64) + begin
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        last = np.r_[first[1:], len(at)] - 1
        yield from zip(at[first].tolist(), (first + begin).tolist(), (last + begin).tolist())


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [f for f, _ in fields])


def _anchor_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    core_bytes = length + 1 - REACH
    for batch in batches:
        rows = []
        for key, text in zip(batch.column("text_key").to_pylist(), batch.column("text").to_pylist()):
            data = _bytes(text)
            view = memoryview(data)
            for at, first, last in anchors(data, length):
                core = xxhash.xxh3_64_intdigest(view[at : at + core_bytes]) - (1 << 63)
                ctx = xxhash.xxh3_128_digest(view[first : last + length], at - first)
                rows.append((key, len(data), core, ctx, at, at - first, at - last))
            if len(rows) > 20_000:
                yield _batch(rows, ANCHORS)
                rows = []
        if rows:
            yield _batch(rows, ANCHORS)


def _strip_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Strips of the wanted contexts of each text."""
    for batch in batches:
        rows = []
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
            data = _bytes(text)
            for w in wanted:
                at, lo, hi = w["at"], w["lo"], w["hi"]
                for strip in range(hi // STRIP, lo // STRIP + 1):
                    near, far = max(hi, strip * STRIP), min(lo, strip * STRIP + STRIP - 1)
                    middle = at - strip * STRIP
                    end = middle - (STRIP - 1) + length
                    digest = xxhash.xxh3_128_digest(memoryview(data)[middle:end])
                    left, right = data[at - far : middle], data[end : at - near + length]
                    rows.append((w["ctx"], strip, digest, left, right, w["n"]))
            if len(rows) > 20_000:
                yield _batch(rows, STRIPS)
                rows = []
        if rows:
            yield _batch(rows, STRIPS)


def _starts(left: bytes, right: bytes) -> range:
    """Distances before the middle at which a strip has a whole string."""
    return range(STRIP - 1 - len(right), len(left) + 1)


def _full(left: bytes, right: bytes) -> int:
    return sum(1 << d for d in _starts(left, right))


def repeats(groups: list[list[tuple[bytes, bytes, int]]]) -> list[list[int]]:
    """Per strip (left, right, count) the mask of distances whose strings occur elsewhere.

    Strips of one group have the same middle. All groups are sorted as one integer text, in
    which no symbol but bytes of one group's strips and its own middle can match.
    """
    width = 2 * STRIP - 1
    count = sum(map(len, groups))
    text = np.empty((count, width + 1), np.int64)
    # 0 ends the text; then unique symbols that part strips and stand for missing bytes.
    unique, middles = 1, 1 + count * (width + 1)
    letters = middles + len(groups)
    row = 0
    for g, group in enumerate(groups):
        for left, right, _ in group:
            own = text[row]
            own[:] = np.arange(unique, unique + width + 1)
            unique += width + 1
            if left:
                own[STRIP - 1 - len(left) : STRIP - 1] = np.frombuffer(left, np.uint8)
                own[STRIP - 1 - len(left) : STRIP - 1] += letters
            own[STRIP - 1] = middles + g
            if right:
                own[STRIP : STRIP + len(right)] = np.frombuffer(right, np.uint8)
                own[STRIP : STRIP + len(right)] += letters
            row += 1
    flat = np.r_[text.ravel(), 0]
    order = np.array(suffix_array(flat.tolist()), np.int64)
    strip, at = order // (width + 1), order % (width + 1)
    keep = (at < STRIP) & (strip < count)
    begin, strip, at = order[keep], strip[keep], at[keep]
    string = flat[begin[:, None] + np.arange(STRIP)]
    same = np.r_[False, (string[1:] == string[:-1]).all(1)]
    found = same | np.r_[same[1:], False]
    masks = np.zeros(count, np.int64)
    np.bitwise_or.at(masks, strip[found], np.int64(1) << (STRIP - 1 - at[found]))
    out, row = [], 0
    for group in groups:
        own = []
        for left, right, n in group:
            full = _full(left, right)
            own.append(full if n > 1 else int(masks[row]) & full)
            row += 1
        out.append(own)
    return out


def _sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Masks of strips that come sorted by middle."""

    def settle(keys: list[bytes], groups: list[list[tuple]]) -> pa.RecordBatch:
        rows = []
        for key, group, masks in zip(keys, groups, repeats(groups)):
            rows += [(key, left, right, mask) for (left, right, _), mask in zip(group, masks) if mask]
        return _batch(rows, MASKS)

    keys: list[bytes] = []
    groups: list[list[tuple]] = []
    symbols = 0
    for batch in batches:
        for middle, left, right, n in zip(*(batch.column(c).to_pylist() for c in ("middle", "left", "right", "n"))):
            if not keys or middle != keys[-1]:
                if symbols >= SYMBOLS:
                    yield settle(keys, groups)
                    keys, groups, symbols = [], [], 0
                keys.append(middle)
                groups.append([])
            groups[-1].append((left, right, n))
            symbols += 2 * STRIP
    if keys:
        yield settle(keys, groups)


def strip_masks(strips: DataFrame) -> DataFrame:
    """Masks of repeated starts for strips (middle, left, right, n), one row for each value.

    Strips alone with their middle and not repeated have no row.
    """
    once = strips.groupBy("middle", "left", "right").agg(F.sum("n").alias("n"))
    same = Window.partitionBy("middle")
    known = stage(once.withColumn("peers", F.count("*").over(same)), "strips")
    known = known.filter((F.col("peers") > 1) | (F.col("n") > 1))
    few = known.filter(F.col("peers") <= SORTED)
    parts = int(strips.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = few.repartition(parts, "middle").sortWithinPartitions("middle").select("middle", "left", "right", "n")
    by_sort = few.mapInArrow(_sorted_groups, MASKS)

    many = known.filter(F.col("peers") > SORTED).withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(STRIP - 1))))
    many = many.filter(
        (F.col("d") <= F.octet_length("left")) & (F.col("d") >= STRIP - 1 - F.octet_length("right"))
    ).withColumn("own_left", F.expr("right(hex(left), 2 * d)")).withColumn(
        "own_right", F.expr(f"left(hex(right), 2 * ({STRIP - 1} - d))")
    )
    value = ["middle", "d", "own_left", "own_right"]
    twice = many.groupBy(*value).agg(F.sum("n").alias("times")).filter(F.col("times") > 1)
    by_count = (
        many.join(twice, value)
        .groupBy("middle", "left", "right")
        .agg(F.sum(F.expr("shiftleft(1, d)")).cast("int").alias("mask"))
    )
    return by_sort.unionByName(by_count)


def removed_runs(n: int, starts: list[tuple[int, int]], length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal runs of bytes that strings starting in the given ranges (both ends included) cover."""
    out: list[list[int]] = []
    for first, last in sorted(starts):
        a, b = first, min(n, last + length)
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _mark_ranges(mark: dict) -> Iterator[tuple[int, int]]:
    at = mark["at"]
    if mark["whole"]:
        yield at - mark["lo"], at - mark["hi"]
        return
    for part in mark["masks"] or ():
        for d in range(STRIP):
            if part["mask"] >> d & 1:
                start = at - part["strip"] * STRIP - d
                yield start, start


def _cut(batches: Iterator[pa.RecordBatch], length: int, keep_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, 500):
            part = batch.slice(begin, 500)
            rows = []
            for doc_id, text, marks in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "marks"))):
                data = _bytes(text)
                runs = removed_runs(len(data), [r for m in marks or () for r in _mark_ranges(m)], length)
                kept, at = [], 0
                for a, b in runs:
                    kept.append(data[at:a])
                    at = b
                kept.append(data[at:])
                rest = b"".join(kept)
                row = (doc_id, len(data), len(data) - len(rest), len(runs), hashlib.sha256(rest).hexdigest())
                rows.append((*row, rest) if keep_text else row)
            yield _batch(rows, OUT + ", kept binary" if keep_text else OUT)


def without_repeats(docs: DataFrame, length: int = LENGTH, keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per document (doc_id, text).

    ``keep_text`` adds the remaining bytes. Null texts are empty; repeated rows are repeats
    of each other; null ids are passed on. Texts are told apart by a 64-bit hash and their
    size; equal texts have equal results.
    """
    if length < REACH + GRAM:
        raise ValueError(f"strings are at least {REACH + GRAM} bytes")
    keyed = picked(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.xxhash64("text").alias("text_key"),
    ).withColumn("size", F.octet_length("text").cast("long"))
    long = keyed.filter(F.col("size") >= length).select("text_key", "size", "text")
    found = stage(long.mapInArrow(lambda b: _anchor_rows(b, length), ANCHORS), "anchors")
    shared = found.groupBy("core").agg(F.count("*").alias("n")).filter(F.col("n") > 1).select("core")
    likely = stage(found.join(shared, "core"), "likely")

    example = F.min(F.struct("text_key", "size", "at", "lo", "hi")).alias("example")
    contexts = stage(
        likely.groupBy("ctx").agg(F.count("*").alias("n"), F.min("core").alias("core"), example), "contexts"
    )
    several = contexts.groupBy("core").agg(F.count("*").alias("contexts")).filter(F.col("contexts") > 1)
    wanted = contexts.join(several.select("core"), "core").select("example.*", "ctx", "n")
    wanted = wanted.groupBy("text_key", "size").agg(F.collect_list(F.struct("ctx", "n", "at", "lo", "hi")).alias("wanted"))
    texts = long.groupBy("text_key", "size").agg(F.first("text").alias("text"))
    strips = stage(
        texts.join(wanted, ["text_key", "size"]).select("text", "wanted").mapInArrow(lambda b: _strip_rows(b, length), STRIPS),
        "cuts",
    )
    masks = (
        strips.join(strip_masks(strips), ["middle", "left", "right"])
        .groupBy("ctx")
        .agg(F.collect_list(F.struct("strip", "mask")).alias("masks"))
    )
    settled = (
        contexts.select("ctx", (F.col("n") > 1).alias("whole"))
        .join(masks, "ctx", "left")
        .filter(F.col("whole") | F.col("masks").isNotNull())
        .withColumn("masks", F.when(~F.col("whole"), F.col("masks")))
    )
    marks = (
        likely.select("text_key", "size", "at", "lo", "hi", "ctx")
        .distinct()
        .join(settled, "ctx")
        .groupBy("text_key", "size")
        .agg(F.collect_list(F.struct("at", "lo", "hi", "whole", "masks")).alias("marks"))
    )
    joined = keyed.join(stage(marks, "marks"), ["text_key", "size"], "left").select("doc_id", "text", "marks")
    return joined.mapInArrow(lambda b: _cut(b, length, keep_text), OUT + ", kept binary" if keep_text else OUT)
