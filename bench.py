"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed completely with the `noop` sink (no driver collect).
`prepare` builds the shared stages (cleaned interactions, holdout split,
ranked items) that the recommendation queries reuse, as the reference
reuses its preprocessed file.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ludora.plans.catalog import QUERIES  # noqa: E402
from ludora.session import get_spark  # noqa: E402

HEADLINE = (
    "jn1_merged",                # PL-1 integrate
    "pl2_preprocessed",          # PL-2 preprocess
    "ag2_nulls_merged",          # PL-3 profile (a representative slice)
    "ag4_describe_merged",
    "ag9_reviews_per_author",
    "ag35_word_frequency",
    "ag42_nulls_three_tables",
    "ev10_cbf_summary",          # flagship: CBF over all unseen items, all test users
    "ev14_summary_3_models",     # every test user x every unseen item, fits included
    "ev15_summary_7_models",
    "ev16_summary_6_models",
)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    os.environ.setdefault("LUDORA_MASTER", f"local[{cpus}]")
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ludora-bench-"))
    times = {}
    # warm-up: JVM start and first planning are not part of any query
    spark.range(10).selectExpr("sum(id)").collect()
    t0 = time.time()
    from ludora.plans.stages import stages
    st = stages(spark, sf_dir)
    st.flagged, st.ranked_items, st.train_ranked_items  # noqa: B018
    times["prepare"] = round(time.time() - t0, 3)
    for name in HEADLINE:
        fn = QUERIES[name][0]
        t = time.time()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else None}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
