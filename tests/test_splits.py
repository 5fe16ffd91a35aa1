import hashlib
import math
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, plan_of
from pagedater.operators import splits
from pagedater.registry import queries


def ordered(keys, seed=42):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))


def hot_rows(n=2000):
    """A third of the rows in one class, a class of one row, and rows without a class."""
    label = lambda i: 1900 if i % 3 == 0 else (None if i % 50 == 1 else 1500 + i % 7 * 50)
    return [(i, label(i)) for i in range(n)] + [(n, 1100)]


def classes(rows):
    groups = defaultdict(list)
    for key, label in rows:
        groups[label].append(key)
    return groups


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.createDataFrame(hot_rows(), "page_id long, semicentury int").repartition(7)


@pytest.mark.parametrize("ranked, digits", [(splits.RANKED, splits.BUCKET_DIGITS), (5, 1), (0, 3)])
def test_stratified_split_is_exact(spark, labelled, monkeypatch, ranked, digits):
    """Also where the bucket of a cut is cut again, down to single hashes."""
    monkeypatch.setattr(splits, "RANKED", ranked)
    monkeypatch.setattr(splits, "BUCKET_DIGITS", digits)
    got = {r.page_id: r.split for r in splits.stratified_split(labelled, "semicentury").collect()}
    expected = {}
    for keys in classes(hot_rows()).values():
        cut = len(keys) - len(keys) * 2 // 10
        for at, key in enumerate(ordered(keys)):
            expected[key] = "train" if at < cut else "eval"
    assert got == expected
    assert got[2000] == "train", "a class of one row stays in train"


def test_train_test_dev_is_a_split_of_a_split(spark, labelled):
    got = {r.page_id: r.split for r in splits.train_test_dev(labelled).collect()}
    first = splits.stratified_split(labelled, "semicentury", 0.2)
    tail = splits.stratified_split(first.filter("split = 'eval'").drop("split"), "semicentury", 0.5)
    assert {k for k, s in got.items() if s == "train"} == {
        r.page_id for r in first.filter("split = 'train'").collect()
    }
    assert {k for k, s in got.items() if s == "dev"} == {
        r.page_id for r in tail.filter("split = 'eval'").collect()
    }
    assert len(got) == labelled.count()


def test_tiny_split_keeps_a_share_of_each_class(spark, labelled):
    split = splits.train_test_dev(labelled)
    sizes = {(r.split, r.semicentury): r["count"] for r in split.groupBy("split", "semicentury").count().collect()}
    tiny = splits.tiny_split(split)
    kept = {(r.split, r.semicentury): r["count"] for r in tiny.groupBy("split", "semicentury").count().collect()}
    for (name, label), n in sizes.items():
        if name != "train":
            assert kept.get((name, label), 0) == n - n * 85 // 100
    assert not [k for k in kept if k[0] == "train"]


@pytest.mark.parametrize("n", [0, 1, 137, 2001, 5000])
def test_sample_n(spark, labelled, n):
    keys = [k for k, _ in hot_rows()]
    got = {r.page_id for r in splits.sample_n(labelled, n).collect()}
    assert got == set(ordered(keys)[:n])


def test_random_split(spark, labelled):
    keys = [k for k, _ in hot_rows()]
    got = splits.random_split(labelled).filter("split = 'test'").collect()
    assert {r.page_id for r in got} == set(ordered(keys, 0)[: math.ceil(Fraction(2, 10) * len(keys))])


def test_columns_and_order_of_rows(spark, labelled):
    rows = labelled.withColumn("text", F.lit("x"))
    assert splits.train_test_dev(rows).columns == ["page_id", "semicentury", "text", "split"]
    again = splits.train_test_dev(rows.orderBy(F.desc("page_id")).coalesce(1))
    assert sorted(again.collect()) == sorted(splits.train_test_dev(rows).collect())


def test_text_is_not_shuffled(spark):
    pages = queries.documents(spark, SMALL).withColumnRenamed("doc_id", "page_id")
    plan = plan_of(splits.stratified_split(pages, "lang"))
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan and "Window" not in plan


def test_many_classes_shuffle(spark, labelled, monkeypatch):
    from pagedater import session

    expected = sorted(splits.stratified_split(labelled, "semicentury").collect(), key=str)
    monkeypatch.setattr(session, "BROADCAST_ROWS", 2)
    got = splits.stratified_split(labelled, "semicentury")
    assert sorted(got.collect(), key=str) == expected


def test_audit(spark, labelled):
    targets = {"train": 0.8, "test": 0.1, "dev": 0.1}
    audit = {r.split: r for r in splits.split_audit(splits.train_test_dev(labelled), targets).collect()}
    assert set(audit) == set(targets)
    assert all(r.ok for r in audit.values())
    off = splits.split_audit(splits.train_test_dev(labelled), {"train": 0.5, "test": 0.1, "dev": 0.1})
    assert not off.filter("split = 'train'").first().ok
