"""Time the headline queries; prints one line of JSON.

Each query is run in full (all columns are produced, nothing is collected) and the best of three runs
is reported. The index is built once, timed as ``index_build``, and searched by the others.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

import inkdex as ix

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("inkdex-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    out = tempfile.mkdtemp(prefix="inkdex-bench-")
    docs = ix.read_table(spark, f"{SF_DIR}/documents.parquet")
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    asked = items.select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    seconds = {}

    def timed(name, action) -> None:
        best = None
        for _ in range(RUNS):
            start = time.perf_counter()
            action()
            spent = time.perf_counter() - start
            best = spent if best is None else min(best, spent)
        seconds[name] = round(best, 3)

    timed("term_frequency", lambda: run(ix.term_frequencies(docs)))
    timed("index_build", lambda: ix.build_index(docs, out))
    index = ix.load_index(spark, out)
    timed("search_single", lambda: run(ix.search(index, "license")))
    timed("search_and", lambda: run(ix.search(index, "of the")))
    timed("phrase_search", lambda: run(ix.phrase_search(index, docs, "of the")))
    timed("search_batch", lambda: run(ix.search_batch(index, asked)))
    timed("phrase_search_batch", lambda: run(ix.phrase_search_batch(index, docs, asked)))
    timed("match_offsets", lambda: run(ix.match_offsets(docs, "of the")))
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": SF_DIR.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
