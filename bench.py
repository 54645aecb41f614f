"""Benchmark the headline queries.

Runs each query of HEADLINE on $BENCH_SF_DIR (default /root/testdata/sf0.1)
with local[$BENCH_CPUS] and prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed completely with the ``noop`` sink (no collect to the
driver); the time includes planning and any driver-side scalar actions the
operator performs.
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
    "basket_rules",
    "basket_itemsets_k3",
    "join_inner",
    "agg_count_pairs",
    "user_listen_stats",
    "song_stats",
    "profile_lineitem",
    "rolling_mean_std",
    "chronological_split",
    "percentile_rank_user",
    "tfidf_keras",
    "vocabulary",
    "roc_auc",
    "classification_report",
    "rec_repair_coverage",
    "rec_negative_samples",
    "mean_intra_distance",
    "clf_knn",
    "optimal_bid_given_rate",
    "similar_users",
    "impute_median",
    "ts_pacf",
    "ts_arima_search",
    "reg_two_features",
    "reg_ridge_sweep",
    "reg_tree_models",
    "reg_linear_models",
    "clf_gaussian_nb_whole",
    "clf_discriminant_whole",
    "clf_models_vote",
    "rec_als_implicit",
    "kmeans_elbow",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from pyspark.sql import SparkSession

    from tessera.plans.catalog import load_all
    from tessera.session import DEFAULT_CONF

    scratch = tempfile.mkdtemp(prefix="tessera-bench-")
    b = SparkSession.builder.master(f"local[{cpus}]").appName("tessera-bench")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = (b.config("spark.sql.shuffle.partitions", str(cpus * 2))
         .config("spark.driver.memory", "16g")
         .config("spark.checkpoint.dir", os.path.join(scratch, "ckpt"))
         .config("spark.sql.warehouse.dir", os.path.join(scratch, "wh")))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    reg = load_all()
    names = [n for n in HEADLINE if n in reg]
    only = os.environ.get("BENCH_ONLY")
    if only:
        names = [n for n in names if re.search(only, n)]
    # Warm-up: JVM class loading and the parquet footer cache, not timed.
    reg["join_inner"].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.time()
        reg[n].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf.group(1)) if sf else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
