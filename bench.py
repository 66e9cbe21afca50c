"""Headline-query benchmark.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each headline query once to completion through the ``noop`` sink (the
whole plan executes, nothing is collected to the driver) and prints ONE JSON
line: {"metric", "value" (sum of query seconds), "unit", "queries", "sf"}.
Set BENCH_QUERIES=a,b to choose queries, BENCH_EVENTLOG=dir to keep Spark's
event log for stage/task timings.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "item_cf_topn",             # R1: co-occurrence cosine, K=20, top 10 (Σ n_u² pair rows)
    "user_cf_topn_weighted",    # R3: user CF Σ w·r
    "evaluate_user_cf",         # E1-E4 on R2 (the published-figure configuration)
    "cosine_items_rated",       # S3: rated cosine, upper triangle
    "jaccard_items",            # S1
    "predict_item_avg",         # R6 sparse algebra on test cells
    "negative_sample",          # P7
    "word_count",               # A8 over whole documents
    "personal_rank",            # R18, 20 rounds
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    from pyspark.sql import SparkSession

    from tastebud.plans.registry import all_queries
    from tastebud.session import RECOMMENDED_CONF

    b = SparkSession.builder.master(f"local[{cpus}]").appName("tastebud-bench")
    conf = dict(RECOMMENDED_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2)),
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "24g"),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    })
    ev = os.environ.get("BENCH_EVENTLOG")
    if ev:
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": ev})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tastebud-bench-ckpt-"))

    qs = all_queries()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        df = qs[name].fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))


if __name__ == "__main__":
    main()
