"""Bounded samples by hash."""

import re

from pyspark.sql import functions as F

from pagedater.llm import common
from tests.conftest import plan_of


def test_least_hashes_are_cut_in_each_task(spark, monkeypatch):
    frame = spark.range(0, 20_000, 1, 6).select("id", (F.col("id") % 2).cast("int").alias("kind"))
    plans = []
    whole = common.least_hashes

    def seen(ranked, most):
        out = whole(ranked, most)
        plans.append(plan_of(out.groupBy("label").count()))
        return out

    monkeypatch.setattr(common, "least_hashes", seen)
    found = common.smallest_hashes(frame, "kind", F.col("id"), 1500).collect()
    rows = frame.select("id", "kind", F.xxhash64("id").alias("h")).collect()
    expected = {r["id"] for k in (0, 1) for r in sorted((r for r in rows if r["kind"] == k), key=lambda r: r["h"])[:1500]}
    assert len(found) == 3000 and {r["id"] for r in found} == expected
    assert len(plans) == 2
    assert all("TakeOrderedAndProject(limit=1500" in p and not re.search(r"\bWindow\b", p) for p in plans)
