"""Packing of documents into sequences by multiway Karmarkar-Karp differencing.

Documents become runs of subword ids, cut into pieces that know their document and start.
Whole windows of a long document stay as they are. The other pieces are dealt at random
into groups of bounded size; within a group the differencing merges partial partitions,
the largest part of one with the smallest of the other, until one partition into near-equal
windows is left. If its largest window exceeds the capacity, the group gets a window more.
Only piece lengths are shuffled, never ids.
"""

from __future__ import annotations

import heapq
import math
import zlib
from bisect import insort
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagedater.llm.common import picked
from pagedater.llm.subword_ids import encoder, vocabulary_path
from pagedater.session import stage

WINDOW = 2048
#: Rests of documents are cut into pieces of at most this many ids, so that windows come out near equal.
PIECE = 256
#: Mean number of pieces that one differencing works on.
GROUP = 2048
END_ID = 1

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def cuts(total: int, window: int = WINDOW, piece: int = PIECE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: whole windows, then even parts of the rest."""
    whole = total // window
    out = [(i * window, window) for i in range(whole)]
    rest = total - whole * window
    parts = math.ceil(rest / piece)
    edges = [whole * window + rest * i // parts for i in range(parts + 1)] if parts else []
    return out + [(a, b - a) for a, b in zip(edges, edges[1:])]


def token_pieces(
    docs: DataFrame,
    tokenizer: str | None = None,
    window: int = WINDOW,
    piece: int = PIECE,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents (doc_id, text), with ids only where asked for.

    A null or empty text is one end id. Repeated rows give repeated pieces, and a null
    doc_id stays null: each row is a document of its own.
    """
    path = tokenizer or vocabulary_path()
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        schema = pa.schema(
            [(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")] + [("ids", pa.binary())]
        )
        for batch in batches:
            rows = []
            texts = [x or "" for x in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts)):
                ids += end
                total = len(ids) // 4
                for start, length in cuts(total, window, piece):
                    part = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, start, length, zlib.crc32(part), total, part if with_ids else None))
            columns = list(zip(*rows)) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return picked(docs, "doc_id", "text").mapInArrow(run, PIECES)


def differencing(sizes: Sequence[int], k: int) -> np.ndarray:
    """Part (0 to k-1) of each size, by largest differencing into k parts.

    A partial partition lists the sums and nodes of its filled parts, smallest first; the
    heap hands out those with the largest difference between greatest and least part.
    """
    n = len(sizes)
    left, right = list(range(n)), [-1] * n
    heap = [(-int(size), i, [(int(size), i)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    tie = n
    while len(heap) > 1:
        _, _, own = heapq.heappop(heap)
        _, _, other = heapq.heappop(heap)
        if len(own) < len(other):
            own, other = other, own
        over = len(own) + len(other) - k
        if over <= 0:
            # Room for all: each part of one stands beside an empty part of the other.
            for part in other:
                insort(own, part)
        else:
            # Smallest beside largest: the fullest parts of either stay alone, as far as there is room.
            made = own[over:] + other[over:]
            for (a, x), (b, y) in zip(own[:over], reversed(other[:over])):
                left.append(x)
                right.append(y)
                made.append((a + b, len(left) - 1))
            made.sort()
            own = made
        least = own[0][0] if len(own) == k else 0
        heapq.heappush(heap, (least - own[-1][0], tie, own))
        tie += 1
    part = np.zeros(n, np.int64)
    for number, (_, top) in enumerate(heap[0][2] if heap else []):
        stack = [top]
        while stack:
            node = stack.pop()
            if node < n:
                part[node] = number
            else:
                stack += (left[node], right[node])
    return part


def windows_of(sizes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Window of each piece: as few as the sum needs, one more whenever one overflows."""
    k = max(1, -(-int(sizes.sum()) // window))
    while True:
        part = differencing(sizes.tolist(), k)
        if len(sizes) == 0 or np.bincount(part, weights=sizes, minlength=k).max() <= window:
            return part
        k += 1


def pack(pieces: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """Give each piece its sequence_id and its offset there; other columns go along.

    ``pieces`` needs a length of 1 to ``window``; an empty table gives an empty one. Pieces
    of the full window are sequences of their own. Equal rows are dealt by a running
    number, not by their values, so no group holds more than its share.
    """
    numbered = stage(pieces.withColumn("_no", F.monotonically_increasing_id()), "pieces")
    full = numbered.filter(F.col("length") == window)
    rest = numbered.filter(F.col("length") != window)
    groups = max(1, math.ceil(rest.count() / group))
    shift = 1 << 20

    def one_group(part: pa.Table) -> pa.Table:
        part = part.sort_by("_no")
        sizes = part["length"].to_numpy().astype(np.int64)
        where = windows_of(sizes, window)
        order = np.argsort(where, kind="stable")
        before = np.cumsum(sizes[order]) - sizes[order]
        first = np.r_[True, where[order][1:] != where[order][:-1]]
        offset = np.empty(len(sizes), np.int64)
        offset[order] = before - before[first][np.cumsum(first) - 1]
        sequence = (part["_group"].to_numpy() * shift + where) * 2 + 1
        part = part.drop_columns(["_no", "_group"])
        return part.append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    # Groups need no key of the data: each holds its own share of a hashed running number.
    dealt = rest.withColumn("_group", F.pmod(F.xxhash64("_no"), F.lit(groups)))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    packed = dealt.groupBy("_group").applyInArrow(one_group, schema)
    alone = full.withColumn("sequence_id", F.col("_no") * 2).withColumn("offset", F.lit(0).cast("long"))
    return packed.unionByName(alone.drop("_no"))


def packed_documents(docs: DataFrame, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """All documents packed: one row per piece."""
    out = pack(token_pieces(docs, tokenizer, with_ids=with_ids))
    return out if with_ids else out.drop("ids")


def padded_length(used: int, window: int = WINDOW) -> int:
    """A sequence is padded to the window, unless its length is a power of two."""
    return used if used and used & (used - 1) == 0 else window


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """The sequences themselves (sequence_id, n_tokens, ids array), padded; needs pieces with ids.

    A sequence gathers at most ``window`` ids, whatever the input.
    """

    def build(part: pd.DataFrame) -> pd.DataFrame:
        ids = np.frombuffer(b"".join(part.sort_values("offset")["ids"]), "<u4").astype(np.int64)
        fill = np.full(padded_length(len(ids), window) - len(ids), pad_id, np.int64)
        return pd.DataFrame(
            {"sequence_id": [part["sequence_id"].iloc[0]], "n_tokens": [len(ids)], "ids": [np.concatenate([ids, fill])]}
        )

    return (
        packed.select("sequence_id", "offset", "ids")
        .groupBy("sequence_id")
        .applyInPandas(build, "sequence_id long, n_tokens long, ids array<long>")
    )
