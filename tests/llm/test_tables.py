"""Top-k search, archives, components and the pipeline."""

import base64
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagedater.llm import topk, warc
from pagedater.llm.components import components
from pagedater.session import staging_path

SMALL = "/root/testdata/sf0.001"


def brute_top(rows, k=10):
    vectors = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole = [int(np.floor(1024 * float(x))) for x in v]
        vectors[i] = min(vectors.get(i, whole), whole)
    out = []
    for q in sorted(i for i in vectors if i % 100 == 0):
        scores = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    return out


def test_top_k_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 100)
    monkeypatch.setattr(topk, "QUERIES", 2)
    draw = random.Random(1)
    rows = [(i, [draw.choice([-0.5, 0.0, 0.25, draw.uniform(-1, 1)]) for _ in range(8)]) for i in range(900)]
    rows += [(900, rows[3][1]), (901, rows[3][1]), (5, rows[5][1]), (1000, None), (None, [1.0] * 8), (1001, [1.0, None]), (1002, [float("inf")] * 8), (1100, []), (1200, [2.0, 1.0]), (1003, [1e6] * 8), (1004, [float("nan")])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    found = sorted(tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 100 == 0).collect())
    assert found == brute_top(rows)
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_products_beyond_floats():
    a, b = np.array([[2.0**40, 1.0]]), np.array([[2.0**20, 1.0]])
    assert topk.products(a, b)[0, 0] == 2**60 + 1


@pytest.mark.parametrize("hot", [1000, 1])
def test_archives_round_trip(spark, scratch, monkeypatch, hot):
    # With 1 no digest is frequent, with 1000 all repeated ones of so few rows are.
    monkeypatch.setattr(warc, "HOT", hot)
    rows = [
        (1, "http://a/\r\nx", "<p>é</p>\r\n\r\nWARC/1.1"), (2, None, None), (3, "u", ""), (4, "u", "same"), (9, "u", "same"),
        (9, "u", "same"), (None, "u", "same"), (None, None, "alone"), (5, "v", "x" * 200_000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_type", F.lit("clash"))
    archive = warc.deduplicated_archives(pages, f"{scratch}/warc{hot}")
    found = sorted((tuple(r) for r in warc.archive_index(archive).collect()), key=repr)
    original = {"": 3, "same": 9}
    expected = []
    for page, _, html in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        first = original.get(html or "", page)
        revisit = page != first
        expected.append((page, len(data), digest, "revisit" if revisit else "response", first if revisit else None))
    assert found == sorted(expected, key=repr)
    texts = {r["page_id"]: r["payload"] for r in archive.collect() if r["record_type"] == "response"}
    assert texts[1] == rows[0][2] and texts[9] == "same" and len(texts[5]) == 200_000
    payloads = warc.page_payloads(pages)
    kinds = {r["page_id"]: r["record_type"] for r in warc.resolve_revisits(payloads, min_bytes=5).collect()}
    assert set(kinds.values()) == {"response"}
    assert warc.archive_index(warc.deduplicated_archives(pages.limit(0), f"{scratch}/none{hot}")).collect() == []


def test_payloads_move_once(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    resolved = warc.resolve_revisits(warc.page_payloads(pages), archive_bytes=1 << 16)
    plan = resolved.transform(warc.records)._jdf.queryExecution().executedPlan().toString()
    moves = [line for line in plan.splitlines() if " Exchange hashpartitioning" in line]
    assert len(moves) == 2 and all("REPARTITION_BY_NUM" in line for line in moves)
    assert "SortMergeJoin" not in plan and plan.count("ShuffledHashJoin") == 1
    assert resolved.rdd.getNumPartitions() > 1


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200, 260)] + [(5, j) for j in range(6, 90)] + [(-3, 5), (300, 300)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 200 for i in range(200, 261)} | {i: -3 for i in (-3, *range(5, 90))}


def test_pipeline_stages(spark):
    import corpus_pipeline
    from pagedater.llm import decontaminate, quality, simhash

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        path = staging_path(spark, name)
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == before.columns
            kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "quality":
            scores = quality.classify(before, spark.read.parquet(f"{SMALL}/labels.parquet")).collect()
            assert set(kept[name]) == {r["doc_id"] for r in scores if r["predicted"] == 1}
        if name == "near_duplicates":
            groups = simhash.near_duplicates(before).collect()
            assert set(kept[name]) == {r["component_id"] for r in groups}
        if name == "decontamination":
            marked = spark.read.parquet(f"{SMALL}/benchmark.parquet")
            leaks = {r["doc_id"] for r in decontaminate.occurrences(before, marked).collect()}
            items = [r["text"] for r in marked.collect()]
            exact = {r["doc_id"] for r in before.collect() if any(x in r["text"] for x in items)}
            assert exact <= leaks and set(kept[name]) == {r["doc_id"] for r in before.collect()} - leaks
    assert set(kept["secrets"]) == set(kept["decontamination"])
    assert {r["doc_id"] for r in docs.select("doc_id").distinct().collect()} == set(kept["secrets"])
    assert all("AKIA" not in (t or "") for t in kept["secrets"].values())


@pytest.mark.parametrize("gone", ["pagedater.llm", "corpus_pipeline"])
def test_entry_without_the_subpackage(gone):
    import subprocess
    import sys

    code = f"import sys; sys.modules['{gone}'] = None; import __spark_entry__ as e; assert e.queries() and not [q for q in e.queries() if q.startswith('op')]"
    subprocess.run([sys.executable, "-c", code], check=True)
