"""Benchmark: run the headline queries and print one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
    BENCH_QUERIES (optional comma list of query names).

Every query is forced with the ``noop`` sink: the whole plan runs on the
executors and nothing is collected to the driver.  Seconds are wall time
per query after one warm-up query (JVM start, first scans).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "r3_predict", "m6_cosine_similarity", "m4_item_gram", "a6_top_k_per_key", "m3_matmul",
    "g1_pagerank", "p1_frequent_itemsets", "p2_association_rules", "l3_auc_roc",
    "x1_corr_matrix", "x5_discretize", "j7_skew_split_join", "j9_salted_count", "j2_cogroup_lists",
    "a10_collect_groups", "t3_pair_similarity", "t5_top_similar", "s1_read_ratings", "f10_gzip_round_trip",
    "f14_json_array_rows", "m7_preference_scores", "m5_off_diagonal", "r4_score_test_pairs", "t2_recent_pair_count",
    "t4_hoeffding_prune", "j3_cross_within_key", "s7_read_similarity",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    from tessera.plans import registry
    from tessera.session import local_session
    registry.load_all()
    spark = local_session(cpus, app="tessera-bench")
    # warm-up: JVM, parquet footers, Python workers
    registry.QUERIES["a8_count_rows"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
