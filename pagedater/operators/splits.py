"""Deterministic splits and samples of exact size, without sorting the data.

Rows are ordered by ``md5(seed:key)``. Instead of ranking every row of a class in
one task, the row that sits at each cut is located: rows are counted per class and
hash bucket, the bucket that holds the cut is picked from the running counts and cut
into finer buckets by the next digits of the hash, until it is small; only then are its
rows ranked. What remains is one boundary per class and cut, and the split is a
comparison with it, so texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import session

# Shares and seed of the published splits.
SEED = 42
EVAL_FRACTION = 0.2
DEV_FRACTION = 0.5
TINY_KEEP = 0.15
TOLERANCE = 0.1
SAMPLE_SIZE = 10_000

# 16**3 buckets at a time: map-side counts shrink to 4,096 rows per class and task, and so
# do the rows of a window over them. A bucket of more than RANKED rows is cut again.
BUCKET_DIGITS = 3
RANKED = 100_000
HASH_DIGITS = 32

Rank = Callable[[Column], Column]


def order_hash(key: str, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def share(n: Column, fraction: float) -> Column:
    """``floor(n * fraction)`` in decimal arithmetic, the same on every engine."""
    exact = F.lit(str(fraction)).cast("decimal(9,6)")
    return F.floor(n.cast("decimal(20,0)") * exact).cast("bigint")


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(and_, [left[c].eqNullSafe(right[f"_{c}"]) for c in columns])


def hash_cuts(
    df: DataFrame, by: Sequence[str], key: str, seed: int, ranks: Mapping[str, Rank]
) -> DataFrame:
    """Per class, the ``(hash, key)`` of the row at each named rank.

    ``ranks`` maps a name to a function of the class size. A rank of 0 has no row,
    so its boundary is NULL and nothing lies below it. The buckets looked for, one
    per class and rank, are staged and broadcast when few, so that each further pass
    over the rows is a filter and only the rows of those buckets are counted or shuffled.
    However many rows there are, a bucket that is ranked has at most ``RANKED`` of them
    (rows that share one hash, so one key, aside).
    """
    classes = [f"_{c}" for c in by]
    keyed = df.select(
        *[F.col(c).alias(f"_{c}") for c in by], F.col(key).alias("_key"), order_hash(key, seed).alias("_hash")
    )
    sizes = keyed.groupBy(*classes, F.substring("_hash", 1, BUCKET_DIGITS).alias("_bucket")).agg(F.count("*").alias("_n"))
    in_class = Window.partitionBy(*classes)
    sized = sizes.withColumn("_size", F.sum("_n").over(in_class))
    named = [F.struct(F.lit(name).alias("cut"), rank(F.col("_size")).alias("rank")) for name, rank in ranks.items()]
    asked = sized.withColumn("_want", F.explode(F.array(*named))).select(
        *classes, "_bucket", "_n", F.col("_want.cut").alias("_cut"), F.col("_want.rank").alias("_nth")
    )
    wanted = session.stage(_holding(asked, [*classes, "_cut"]), "buckets")
    digits = BUCKET_DIGITS
    while digits < HASH_DIGITS and (wanted.agg(F.max("_n")).first()[0] or 0) > RANKED:
        inside = _inside(keyed, wanted, classes, digits)
        digits = min(digits + BUCKET_DIGITS, HASH_DIGITS)
        finer = inside.groupBy(*classes, "_cut", "_nth", F.substring("_hash", 1, digits).alias("_bucket"))
        wanted = session.stage(_holding(finer.agg(F.count("*").alias("_n")), [*classes, "_cut"]), "buckets")
    in_bucket = Window.partitionBy(*classes, "_cut").orderBy("_hash", "_key")
    located = (
        _inside(keyed, wanted, classes, digits)
        .withColumn("_row", F.row_number().over(in_bucket))
        .filter(F.col("_row") == F.col("_nth"))
    )
    boundary = F.struct(F.col("_hash").alias("hash"), F.col("_key").alias("key"))
    return located.groupBy(*classes).agg(
        *[F.max(F.when(F.col("_cut") == name, boundary)).alias(f"_{name}") for name in ranks]
    )


def _holding(counts: DataFrame, cut: Sequence[str]) -> DataFrame:
    """Of the buckets of each cut the one that holds its rank; the rank counts from there on."""
    running = Window.partitionBy(*cut).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("_before", F.coalesce(F.sum("_n").over(running), F.lit(0)))
    held = (F.col("_nth") > F.col("_before")) & (F.col("_nth") <= F.col("_before") + F.col("_n"))
    return placed.filter(held).select(*cut, "_bucket", "_n", (F.col("_nth") - F.col("_before")).alias("_nth"))


def _inside(keyed: DataFrame, wanted: DataFrame, classes: Sequence[str], digits: int) -> DataFrame:
    """The rows of the buckets looked for, which have so many digits, beside their cut and rank."""
    found = session.broadcast_if_small(wanted)
    same = [keyed[c].eqNullSafe(wanted[c]) for c in classes]
    same.append(F.substring(keyed["_hash"], 1, digits) == wanted["_bucket"])
    return keyed.join(found, reduce(and_, same)).select(
        *[keyed[c] for c in classes], keyed["_key"], keyed["_hash"], wanted["_cut"], wanted["_nth"]
    )


def _below(name: str, key: str, seed: int) -> Column:
    """Whether a row lies at or below a boundary."""
    here = F.struct(order_hash(key, seed).alias("hash"), F.col(key).alias("key"))
    return F.coalesce(here <= F.col(f"_{name}"), F.lit(False))


def with_cuts(
    df: DataFrame,
    by: Sequence[str],
    key: str,
    seed: int,
    ranks: Mapping[str, Rank],
    choose: Callable[[Callable[[str], Column]], Column],
    column: str,
) -> DataFrame:
    """Add ``column``, computed from where a row lies relative to its class's cuts.

    The boundaries (one row per class) are staged and counted, and broadcast when
    they are few, as classes are; otherwise the join shuffles on the class.
    """
    columns, classes = df.columns, list(by)
    if not classes:
        df, classes = df.withColumn("_all", F.lit(0)), ["_all"]
    cuts = session.stage(hash_cuts(df, classes, key, seed, ranks), "cuts")
    joined = df.join(session.broadcast_if_small(cuts), _same(df, cuts, classes), "left")
    return joined.select(
        *[df[c] for c in columns if c != column],
        choose(lambda name: _below(name, key, seed)).alias(column),
    )


def stratified_split(
    df: DataFrame,
    by: str | Sequence[str],
    eval_frac: float = EVAL_FRACTION,
    key: str = "page_id",
    seed: int = SEED,
) -> DataFrame:
    """Add ``split``: in each class, the last ``floor(n * eval_frac)`` rows are ``eval``.

    ``key`` must be unique. A class too small for a row of its own stays in ``train``.
    """
    by = [by] if isinstance(by, str) else list(by)
    return with_cuts(
        df,
        by,
        key,
        seed,
        {"train": lambda n: n - share(n, eval_frac)},
        lambda below: F.when(below("train"), "train").otherwise("eval"),
        "split",
    )


def train_test_dev(
    df: DataFrame, by: str = "semicentury", key: str = "page_id", seed: int = SEED
) -> DataFrame:
    """80/10/10 per class: a split at 0.2, and its tail split at 0.5, in one pass."""

    def train(n: Column) -> Column:
        return n - share(n, EVAL_FRACTION)

    def test(n: Column) -> Column:
        return n - share(share(n, EVAL_FRACTION), DEV_FRACTION)

    return with_cuts(
        df,
        [by],
        key,
        seed,
        {"train": train, "test": test},
        lambda below: F.when(below("train"), "train").when(below("test"), "test").otherwise("dev"),
        "split",
    )


def tiny_split(
    df: DataFrame,
    keep: float = TINY_KEEP,
    by: str = "semicentury",
    key: str = "page_id",
    seed: int = SEED,
) -> DataFrame:
    """Keep a share of each class of ``test`` and of ``dev``."""
    held_out = df.filter(F.col("split").isin("test", "dev"))
    dropped = round(1 - keep, 6)
    marked = with_cuts(
        held_out,
        ["split", by],
        key,
        seed,
        {"kept": lambda n: n - share(n, dropped)},
        lambda below: below("kept"),
        "_keep",
    )
    return marked.filter("_keep").drop("_keep")


def split_audit(
    df: DataFrame, targets: Mapping[str, float], tolerance: float = TOLERANCE
) -> DataFrame:
    """Rows and share of each split, its target, and whether it is within tolerance.

    The deviation is relative to the target.
    """
    sizes = df.groupBy("split").agg(F.count("*").alias("rows"))
    # One row per split: the window sees a handful of rows.
    total = F.sum("rows").over(Window.partitionBy(F.lit(0)))
    target = F.create_map(*[F.lit(x) for pair in targets.items() for x in pair])
    audited = sizes.select(
        "split",
        "rows",
        (F.col("rows") / total).alias("share"),
        F.try_element_at(target, F.col("split")).alias("target"),
    )
    deviation = F.abs(F.col("share") - F.col("target")) / F.col("target")
    return audited.withColumn("ok", deviation <= tolerance)


def sample_n(
    df: DataFrame, n: int = SAMPLE_SIZE, seed: int = SEED, key: str = "page_id"
) -> DataFrame:
    """A reproducible random sample of ``n`` rows (all rows when there are fewer)."""
    marked = with_cuts(
        df,
        [],
        key,
        seed,
        {"kept": lambda size: F.least(size, F.lit(n).cast("bigint"))},
        lambda below: below("kept"),
        "_keep",
    )
    return marked.filter("_keep").drop("_keep")


def random_split(
    df: DataFrame, frac: float = EVAL_FRACTION, seed: int = 0, key: str = "page_id"
) -> DataFrame:
    """Add ``split``: exactly ``ceil(frac * n)`` rows are ``test``, not stratified."""
    return with_cuts(
        df,
        [],
        key,
        seed,
        {"test": lambda n: -F.floor(-n.cast("decimal(20,0)") * F.lit(str(frac)).cast("decimal(9,6)")).cast("bigint")},
        lambda below: F.when(below("test"), "test").otherwise("train"),
        "split",
    )
