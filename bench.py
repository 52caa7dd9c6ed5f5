"""Headline-query benchmark.

Runs a fixed set of registered queries over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}.
Each query is executed fully through the ``noop`` sink (no driver collect);
one warm-up run precedes the timed run.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "c19_influence_returnflag", "c19_influence_multi", "c10_association_ranking", "c8_cramers_v_matrix",
    "c1_pearson_matrix", "c2_spearman_matrix", "m1_real_missing_summary", "m2_disguised_missing_summary",
    "d1_exact_duplicates_summary", "d4_duplicate_rows", "r2_describe_numeric", "r12_constant_columns",
    "o1_iqr_summary", "o6_mad_summary", "o10_outlier_audit", "n2_zscore_scale", "n3_decimal_scale",
    "e6_categorical_variant", "e16_qcut", "v1_histogram", "v4_box_stats", "v7_kde",
    "k26_calinski_harabasz", "k25_silhouette", "k30_representatives", "l8_knn_classifier", "k13_dbscan_labels",
    "k19_k_distance", "k21_single_linkage", "n5_compare_versions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tablewise.session import get_spark
    from tablewise.plans.registry import QUERIES, load_all
    spark = get_spark("tablewise-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    load_all()
    names = [n for n in HEADLINE if n in QUERIES]
    if len(sys.argv) > 1:
        names = [n for n in QUERIES if any(re.search(p, n) for p in sys.argv[1:])]
    times = {}
    for name in names:
        for attempt in range(2):  # warm-up, then timed
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
        times[name] = round(dt, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
