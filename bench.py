"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and materialised in full with a ``noop`` write (no driver
collect) once, after one warm-up query.  Prints one JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}
Set BENCH_QUERIES to a comma list to run a subset.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tessera.plans import registry  # noqa: E402
from tessera.session import ship_package  # noqa: E402

# The headline set: the recipes and the operators that carry their work.
HEADLINE = [
    "corpus_plain", "corpus_counts", "corpus_wiki", "clean_wiki_text", "split_sentences",
    "random_spans", "dedup_exact", "dedup_recent", "dedup_lru", "limit_sentences",
    "bootstrap_sample", "shuffle_sample", "read_lines", "read_paragraphs", "json_docs",
    "pretokenize", "word_counts", "alphabet", "pair_counts", "wordpiece_segment", "encode",
    "line_by_line", "pack_blocks", "mask_tokens", "length_batches", "pad_batch",
    "training_table", "evaluation", "perplexity", "learn_wordpiece",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    scratch = tempfile.mkdtemp(prefix="tessera-bench-")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("tessera-bench")
             .config("spark.sql.shuffle.partitions", str(max(int(cpus) * 2, 8)))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "16g")
             .config("spark.sql.execution.arrow.pyspark.enabled", "true")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    queries = registry.queries()
    timings: dict[str, float] = {}
    # one warm-up query for the JVM and the Python workers, then one timed run each
    queries["corpus_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in names:
        fn = queries[name]
        t0 = time.perf_counter()
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings,
                      "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
