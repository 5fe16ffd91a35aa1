"""Exact top-k inner products by block-at-a-time pruning.

Vectors are sparse documents whose terms are signed dimensions. They are dealt to shards,
ordered within a shard so that similar ones lie together, and cut into blocks of consecutive
documents; a block keeps the greatest and least weight of each term. For a query the sum
over terms of query weight times the fitting extreme bounds every score in the block. Blocks
are scored in descending order of that bound, from the block's own rows, until the bound
falls below the k-th score so far. A first round over one shard for each query gives a k-th
score to start from; the second round meets every shard, so the result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagedater.llm.common import picked
from pagedater.session import stage

SCALE = 1024
#: Rows of a shard on average, of a block, and queries that go together.
SHARD = 4096
BLOCK = 64
QUERIES = 256
#: Largest sum that float64 products hold exactly.
EXACT = 2.0**53
LONG = (-(1 << 63), (1 << 63) - 1)

PACKED = "part int, size int, width int, ids binary, rows binary"
HITS = "query_id long, vec_id long, score long"


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * float(scale)).cast("double"))


def usable(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): one row per id, v the integer components.

    Left out: null ids, null vectors, and vectors with a null, infinite or NaN component.
    Where rows share an id the smallest vector in array order counts.
    """
    known = picked(vectors, "vec_id", "embedding").filter(
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    )
    return known.select(F.col("vec_id").cast("long").alias("vec_id"), integers(F.col("embedding"), scale).alias("v"))


def _packed(rows: Iterator[pa.RecordBatch], size: int, order: bool) -> Iterator[pa.RecordBatch]:
    """Batches of (part, vec_id, v), sorted by part, as matrices of at most ``size`` rows."""
    names = [x.split()[0] for x in PACKED.split(", ")]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    held: list[tuple[int, list[float]]] = []
    now = None

    def out() -> pa.RecordBatch:
        ids = np.array([i for i, _ in held], np.int64)
        width = max(len(v) for _, v in held)
        matrix = np.zeros((len(held), width))
        for i, (_, v) in enumerate(held):
            matrix[i, : len(v)] = v
        if order:
            # Signs of fixed random projections bring similar rows near each other.
            planes = np.random.default_rng(width).standard_normal((width, 12))
            code = ((matrix @ planes) > 0) @ (1 << np.arange(12))
            by = np.lexsort((ids, code))
            ids, matrix = ids[by], matrix[by]
        small = np.abs(matrix).max(initial=0) < 2**15
        data = matrix.astype(np.int16 if small else np.float64).tobytes()
        # The sign of the size tells the width of the numbers.
        values = (now, len(ids) if small else -len(ids), width, ids.tobytes(), data)
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(values, kinds)], names)

    last = None
    for batch in rows:
        for part, vec_id, v in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if vec_id == last:
                continue
            if held and (part != now or len(held) == size):
                yield out()
                held = []
            now, last = part, vec_id
            held.append((vec_id, v))
    if held:
        yield out()


def packed(rows: DataFrame, parts: int, size: int, order: bool) -> DataFrame:
    """Deal (vec_id, v) into ``parts`` by id and pack each into matrices."""
    dealt = rows.withColumn("part", _part(F.col("vec_id"), parts))
    # In order, rows of one id lie together, the smallest vector first; it alone is packed.
    in_order = dealt.repartition(parts, "part").sortWithinPartitions("part", "vec_id", "v").select("part", "vec_id", "v")
    return in_order.mapInArrow(lambda batches: _packed(batches, size, order), PACKED)


def _part(vec_id: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(vec_id), F.lit(parts)).cast("int")


def unpack(size: int, width: int, ids: bytes, rows: bytes) -> tuple[np.ndarray, np.ndarray]:
    kind = np.int16 if size > 0 else np.float64
    return np.frombuffer(ids, np.int64), np.frombuffer(rows, kind).reshape(abs(size), width).astype(np.float64)


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products; beyond what floats hold exactly, by whole numbers, within a long."""
    if np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(1, queries.shape[1]) < EXACT:
        return (queries @ rows.T).astype(np.int64)
    whole = np.array([[int(x) for x in r] for r in queries], object) @ np.array([[int(x) for x in r] for r in rows], object).T
    return np.array([[min(max(int(x), LONG[0]), LONG[1]) for x in r] for r in whole], np.int64).reshape(len(queries), len(rows))


def best(
    query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int
) -> Iterator[tuple[int, int, int]]:
    """For each query the k best rows of a shard that reach its floor (query, row, score).

    Ties go to the smaller id, so a block whose bound equals the k-th score is still scored.
    """
    width = max(queries.shape[1], rows.shape[1])
    queries = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
    rows = np.pad(rows, ((0, 0), (0, width - rows.shape[1])))
    edges = np.arange(0, len(rows), BLOCK)
    high, low = np.maximum.reduceat(rows, edges), np.minimum.reduceat(rows, edges)
    bound = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    # Rounding of sums too large for floats must not hide a block.
    bound += np.abs(bound) * 1e-9
    for q, query_id in enumerate(query_ids.tolist()):
        kth = float(floor[q])
        got: list[tuple[int, int]] = []
        for block in np.argsort(-bound[q], kind="stable").tolist():
            if bound[q, block] < kth:
                break
            at = slice(block * BLOCK, block * BLOCK + BLOCK)
            scores = products(queries[q : q + 1], rows[at])[0]
            keep = np.flatnonzero((scores >= kth) & (ids[at] != query_id))
            got += [(-int(s), int(i)) for s, i in zip(scores[keep], ids[at][keep])]
            if len(got) >= k:
                got = sorted(got)[:k]
                kth = max(kth, float(-got[-1][0]))
        for score, vec_id in got[:k] if len(got) <= k else sorted(got)[:k]:
            yield query_id, vec_id, -score


def _scored(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in HITS.split(", ")]
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            query_ids, queries = unpack(row["q_size"], row["q_width"], row["q_ids"], row["q_rows"])
            ids, rows = unpack(row["size"], row["width"], row["ids"], row["rows"])
            floor = np.full(len(query_ids), -np.inf)
            if row.get("floors") is not None:
                known = {f["query_id"]: f["kth"] for f in row["floors"]}
                floor = np.array([known.get(q, -np.inf) for q in query_ids.tolist()], float)
            found = list(zip(*best(query_ids, queries, floor, ids, rows, k))) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names)


def _score(pairs: DataFrame, k: int) -> DataFrame:
    return pairs.mapInArrow(lambda batches: _scored(batches, k), HITS)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = SCALE) -> DataFrame:
    """The k best other vectors of each query: query_id, rank (from 1), vec_id, score.

    ``vectors`` has vec_id and embedding; ``is_query`` picks the queries among them. Vectors
    of other lengths are taken as padded with zeros. An empty table gives an empty result.
    Queries and shards meet in a grid of tiles, each tile one row of a hash-dealt join.
    """
    known = usable(vectors, scale)
    counts = known.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    shards, chunks = math.ceil(counts["n"] / SHARD) or 1, math.ceil(counts["q"] / QUERIES) or 1
    data = stage(packed(known, shards, 2 * SHARD, True), "shards")
    asked = packed(known.filter(is_query), chunks, 2 * QUERIES, False)
    asked = stage(
        asked.select(F.col("part").alias("chunk"), *(F.col(c).alias(f"q_{c}") for c in ("size", "width", "ids", "rows"))),
        "queries",
    )
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    # First round: each chunk of queries over one shard gives its k-th scores there.
    first = asked.withColumn("part", F.pmod(F.col("chunk"), F.lit(shards))).join(data, "part")
    ranked = _score(first, k).withColumn("rank", F.row_number().over(by_score))
    kth = ranked.filter(F.col("rank") == k).select(
        _part(F.col("query_id"), chunks).alias("chunk"), F.struct("query_id", F.col("score").alias("kth")).alias("floor")
    )
    # A chunk's floors ride with it, as many as it has queries.
    floors = kth.groupBy("chunk").agg(F.collect_list("floor").alias("floors"))

    # Second round: the grid of chunks and shards.
    across = asked.join(floors, "chunk", "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    down = data.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    found = _score(across.join(down, ["chunk", "part"]), k)
    return (
        found.withColumn("rank", F.row_number().over(by_score))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
