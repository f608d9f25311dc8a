"""Benchmark the headline queries.

Runs J1 (flagship corpus job), the four source cleaners (E13-E16), exact dedup
(F2) and the vocabulary build (G2) over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints one JSON line.
Each query runs to completion through the ``noop`` sink (full plan, nothing
collected to the driver).

A corpus arrives in many splits; the test table is one file with one row group,
which a single core would read.  So the table is first laid out in two files a
core (untimed, the rows unchanged), and the queries read that.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["q_process_corpus", "q_process_corpus_nogates", "q_clean_books", "q_clean_gutenberg", "q_clean_web",
            "q_clean_wiki", "q_dedup_exact", "q_vocab_topk"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from textmill import get_session
    from textmill.plans.catalog import QUERIES

    scratch = tempfile.mkdtemp(prefix="textmill-bench-")
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"), "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
             # One of the laid-out files is one split, however small the test table.
             "spark.sql.files.openCostInBytes": str(32 << 20)}
    if os.environ.get("BENCH_EVENT_LOG"):
        # Stage / task timings for tools/stages.py (a scratch folder of your own).
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]})
    spark = get_session(f"local[{cpus}]", int(cpus) * 2, app_name="textmill-bench", extra=extra)
    # Warm up the JVM (JIT of the regex / higher-order-function paths) and the
    # parquet reader on the smallest tables next to the benchmark ones; not timed.
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    laid_out = {}
    for place in dict.fromkeys((warm_dir if os.path.isdir(warm_dir) else sf_dir, sf_dir)):
        laid_out[place] = os.path.join(scratch, os.path.basename(place.rstrip("/")))
        docs = spark.read.parquet(os.path.join(place, "documents.parquet"))
        docs.repartition(2 * int(cpus)).write.parquet(os.path.join(laid_out[place], "documents.parquet"))
    for name in ("q_md5", "q_process_corpus"):
        QUERIES[name](spark, next(iter(laid_out.values()))).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, laid_out[sf_dir]).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    n_docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet")).count()
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "docs": n_docs,
                      "j1_docs_per_sec": round(n_docs / times["q_process_corpus"], 1)}))


if __name__ == "__main__":
    main()
