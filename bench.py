"""Headline queries, timed: prints one JSON line. BENCH_SF_DIR and BENCH_CPUS set the tables and the cores."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

#: Published training times: joined corpus, least count 2, vocabularies 260 and 300; per document, least count 10, vocabulary 300.
QUERIES = ["q01_mean_length", "q02_doc_lengths", "q05_pair_freq", "q07_apply_merge", "q10_encode", "q12_splits", "q18_windows_512_512", "q19_batches", "q20_budget_grid", "q22_linear", "q23_causal_attention", "q28_cross_entropy", "q30_greedy_step"]


def main() -> None:
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from lathe.operators import bpe
    from lathe.plans import catalogue
    from lathe.sources import corpus

    spark.range(1000).selectExpr("sum(id)").collect()
    took: dict[str, float] = {}
    docs = corpus.documents(spark, SF_DIR)
    began = time.perf_counter()
    half, _ = bpe.train(docs, 260, 2, "joined")
    took["train_joined_260"] = round(time.perf_counter() - began, 3)
    bpe.train(docs, 300, 2, "joined", half)  # goes on from the first four rules, and applies them again
    took["train_joined_300"] = round(time.perf_counter() - began, 3)
    began = time.perf_counter()
    bpe.train(docs, 300, 10)
    took["train_bounded_300"] = round(time.perf_counter() - began, 3)
    for name in QUERIES:
        began = time.perf_counter()
        catalogue.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "byte-pair training, joined corpus, vocabulary 300", "value": took["train_joined_300"], "unit": "sec", "queries": took, "sf": os.path.basename(os.path.normpath(SF_DIR)).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
