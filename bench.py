"""Time the headline queries on one machine and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the
data and the cores. Names on the command line choose the queries. Every query runs
to completion into a sink that keeps all columns and rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pagedater.registry.queries import QUERIES
from pagedater.session import local_session

HEADLINE = [
    "flagship_class_distribution",
    "s1_read_dump",
    "p1_drop_namespaces",
    "p6_min_length",
    "p7_known_quality",
    "p8_drop_transcluding",
    "w1_page_categories",
    "w3_plain_text",
    "w4_page_templates",
    "a1_book_categories",
    "j1_restore_categories",
    "j2_restore_categories_broadcast",
    "a2_category_distribution",
    "a6_year_distribution",
    "a7_class_distribution",
    "d4_publication_year",
    "d5_period_label",
    "x1_stratified_split",
    "x2_train_test_dev",
    "x3_tiny_split",
    "x5_sample_n",
    "x6_random_split",
    "f1_word_tokens",
    "f2_subword_tokens",
    "f3_learn_merges",
    "f5_prune_vocabulary",
    "f6_bag_of_words",
    "f8_feature_table",
    "m1_decision_tree",
    "m2_svm",
    "m3_naive_bayes",
    "m4_mlp",
    "e2_confusion",
    "e3_class_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    # Start the catalog and the Python workers before the clock runs.
    spark.range(1000).mapInPandas(lambda batches: batches, "id long").count()
    QUERIES["p1_drop_namespaces"](spark, sf_dir).count()

    seconds: dict[str, float] = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    result = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
