"""A Merkle manifest of a table as a persistent, path-copying tree.

A leaf is the digest of a row's columns; leaves stand in one tree for each language, and the
roots of those trees, by language, in one tree above them. A node is the digest of its two
children's digests, of one where the level ends. Nodes are never changed: a tampered leaf
makes a *version* of the tree that shares every untouched node and copies only the
ancestors of that leaf.

A tree is cut into aligned blocks of ``1 << HEIGHT`` neighbouring nodes. A block is one row,
its levels are built in a task; the tops of the blocks are the nodes of the next phase, and
so on up. On the way down each block gets the siblings above it, so that a version that
leaves its block goes on over the upper levels wherever the block lies. No task holds more
than one block and the siblings above it, however large a tree is.

Rows are numbered by a range sort over ``(language, id, leaf)`` with counts by partition, so
neither a language nor an id is gathered anywhere. Null columns enter the leaf as ``-``. A
null id stands first and is never tampered with; rows that share an id stand by their leaves;
repeated rows have equal leaves, each with a place of its own. Null is a language, the first
one. Empty texts are values, very long ones are read once and do not travel; other columns
are left aside. An empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagedater.llm.common import picked
from pagedater.session import broadcast_if_small, stage

LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of a block.
HEIGHT = 10

AUDIT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
PATHS = "tree string, block long, path array<string>, subroot string, root string"


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def height(size: int) -> int:
    """Levels above a row of nodes until one is left."""
    return max(0, size - 1).bit_length()


def field(value: Column) -> Column:
    """A value as it enters a leaf: its length in bytes, a colon, itself; null is ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """``(tree, doc_id, digest, changed)``: the leaf, and what tampering makes of it, else null.

    Tampering adds 1 to ``n_chars``; a null stays.
    """
    read = picked(docs, *LEAF_COLUMNS)
    plain = {name: F.col(name) for name in LEAF_COLUMNS}
    more = plain | {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    return read.select(
        F.col("lang").alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf(*plain.values()).alias("digest"),
        F.when(F.coalesce(tampered, F.lit(False)), leaf(*more.values())).alias("changed"),
    )


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Add ``position`` in the row's tree and ``size``, the rows of the tree.

    ``order`` sorts within a tree; what it leaves equal stays as the rows are stored.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["tree", *order, "tie"]
    stored = stage(rows.withColumn("tie", F.monotonically_increasing_id()), "leaves")
    ordered = stored.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys).drop("tie")
    # The upper bits number the partition, the lower ones the row in it.
    ordered = stage(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("at", 33)
    runs = ordered.groupBy("tree", part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("tree").alias("run_tree"),
        F.col("part").alias("run_part"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(tree).alias("size"),
    )
    runs = broadcast_if_small(stage(runs, "runs"))
    same = F.col("tree").eqNullSafe(F.col("run_tree")) & (part == F.col("run_part"))
    return ordered.join(runs, same).withColumn("position", F.col("at") + F.col("shift")).drop("run_tree", "run_part", "shift", "at")


def in_blocks(nodes: DataFrame) -> DataFrame:
    """Aligned blocks ``(tree, block, size, nodes)``, their nodes by position."""
    node = F.struct("position", "digest", "changed", "doc_id")
    return (
        nodes.groupBy("tree", "size", F.shiftright("position", HEIGHT).alias("block"))
        .agg(F.sort_array(F.collect_list(node)).alias("nodes"))
        .select("tree", "block", "size", "nodes")
    )


class Block:
    """The nodes of an aligned block: levels of digests, from its lowest nodes to its top."""

    def __init__(self, lowest: list[str], size: int, most: int):
        """``size`` is that of the whole level: a tree that ends within the block ends there."""
        self.levels = [lowest]
        for _ in range(min(most, height(size))):
            below = self.levels[-1]
            self.levels.append([digest(*below[i : i + 2]) for i in range(0, len(below), 2)])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def siblings(self, place: int) -> list[str]:
        """What each level adds beside the path from a place: ``L`` or ``R`` and a digest, or nothing."""
        out = []
        for level in self.levels[:-1]:
            other = place ^ 1
            out.append(("L" if other < place else "R") + level[other] if other < len(level) else "")
            place >>= 1
        return out


def version(changed: str, siblings: list[str]) -> list[str]:
    """The copied ancestors of a changed node, from its parent up; all else is shared."""
    copies = []
    for sibling in siblings:
        if not sibling:
            changed = digest(changed)
        elif sibling[0] == "L":
            changed = digest(sibling[1:], changed)
        else:
            changed = digest(changed, sibling[1:])
        copies.append(changed)
    return copies


def tops(blocks: DataFrame) -> DataFrame:
    """The tops of blocks as nodes of the next phase."""
    most = HEIGHT

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).to_pylist()
            lowest = batch.column(3).to_pylist()
            found = [Block(nodes, size, most).top for size, nodes in zip(sizes, lowest)]
            sizes = pa.array([-(-size >> most) for size in sizes], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), sizes, pa.array(found, pa.string())], names=["tree", "position", "size", "digest"]
            )

    read = blocks.select("tree", "block", "size", "nodes.digest")
    built = read.mapInArrow(build, "tree string, position long, size long, digest string")
    return built.withColumns({"changed": F.lit(None).cast("string"), "doc_id": F.lit(None).cast("long")})


@dataclass
class Forest:
    """Trees over numbered nodes: the blocks of every phase, and ``(tree, digest)`` of the roots."""

    phases: list[DataFrame]
    roots: DataFrame

    def paths(self, above: DataFrame) -> DataFrame:
        """The siblings above each block of the lowest phase, with the columns of PATHS.

        ``above`` has those of each tree, as of its only block 0.
        """
        for blocks in reversed(self.phases[1:]):
            above = stage(_with_paths(blocks, above).mapInArrow(partial(_paths_below, most=HEIGHT), PATHS), "paths")
        return above


def forest(nodes: DataFrame) -> Forest:
    """Grow trees from ``(tree, size, position, digest, changed, doc_id)`` rows, phase by phase."""
    phases = []
    while True:
        phases.append(stage(in_blocks(nodes), "blocks"))
        nodes = stage(tops(phases[-1]), "tops")
        if (nodes.agg(F.max("size")).first()[0] or 1) == 1:
            return Forest(phases, nodes.select("tree", "digest"))


def _with_paths(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Blocks beside the siblings above them."""
    up = above.select(
        F.col("tree").alias("up_tree"), F.col("block").alias("up_block"), "path", "subroot", "root"
    )
    same = F.col("tree").eqNullSafe(F.col("up_tree")) & (F.col("block") == F.col("up_block"))
    return blocks.join(up, same).select("tree", "size", "nodes", "path", "subroot", "root")


def _paths_below(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """For every node of a block, its siblings up to the root."""
    kinds = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.string(), pa.string()]
    names = ["tree", "block", "path", "subroot", "root"]
    for batch in batches:
        for row in batch.to_pylist():
            nodes = row["nodes"]
            block = Block([x["digest"] for x in nodes], row["size"], most)
            columns = [
                [row["tree"]] * len(nodes),
                [x["position"] for x in nodes],
                [block.siblings(i) + row["path"] for i in range(len(nodes))],
                [row["subroot"]] * len(nodes),
                [row["root"]] * len(nodes),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _audited(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """For every leaf of a block its proof, and the root that its version folds to."""
    kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_(), pa.list_(pa.string())]
    names = [*(x.split()[0] for x in AUDIT.split(", ")), "copies"]
    for batch in batches:
        for row in batch.to_pylist():
            block = Block([x["digest"] for x in row["nodes"]], row["size"], most)
            out = []
            for place, node in enumerate(row["nodes"]):
                siblings = block.siblings(place) + row["path"]
                copies = version(node["changed"] or node["digest"], siblings)
                folded = copies[-1] if copies else node["changed"] or node["digest"]
                proof = digest(*(x[1:] for x in siblings))
                out.append((node["doc_id"], node["digest"], row["subroot"], row["root"], proof, folded, folded == row["root"], copies if node["changed"] else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def versions(docs: DataFrame, tampered: Column) -> DataFrame:
    """A row per document: the columns of AUDIT and ``copies``, the nodes its version copied.

    ``copies`` lists new digests from the leaf's parent to the version's root, and is null
    where nothing was tampered with; every other node of the version is the manifest's own.
    """
    below = forest(numbered(leaves(docs, tampered), "doc_id", "digest"))
    subroots = below.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    placed = numbered(subroots, "name").withColumns(
        {"changed": F.lit(None).cast("string"), "doc_id": F.lit(None).cast("long")}
    )
    placed = stage(placed, "subroots")
    top = forest(placed)
    start = top.roots.select(
        "tree", F.lit(0).cast("long").alias("block"), F.array().cast("array<string>").alias("path"),
        F.lit("").alias("subroot"), F.col("digest").alias("root"),
    )
    # The siblings of every subroot; its tree's name and digest come from the numbered table.
    at_top = _with_paths(top.phases[0], top.paths(start)).mapInArrow(partial(_paths_below, most=HEIGHT), PATHS)
    names = placed.select("position", F.col("name").alias("tree"), F.col("digest").alias("subroot"))
    above = at_top.select(F.col("block").alias("position"), "path", "root").join(names, "position")
    above = above.select("tree", F.lit(0).cast("long").alias("block"), "path", "subroot", "root")
    audited = _with_paths(below.phases[0], below.paths(stage(above, "above")))
    return audited.mapInArrow(partial(_audited, most=HEIGHT), f"{AUDIT}, copies array<string>")


def every_seventh(key: str = "doc_id") -> Column:
    """Whether 7 divides the crc32 of the key as text."""
    return F.crc32(F.col(key).cast("string")) % 7 == 0


def audit(docs: DataFrame) -> DataFrame:
    """The columns of AUDIT: leaf, roots, proof, and whether the version of every row has the root."""
    return versions(docs, every_seventh()).drop("copies")
