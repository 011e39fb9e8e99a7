"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the folder of the tables, ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES``
(comma-separated names, or ``all``) another set of queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from workload import QUERIES

HEADLINE = [
    "l1_build_qtl",
    "l2_build_gene_list_links",
    "l3_build_capture_links",
    "l4_build_enhancer_links",
    "l5_build_correlation_links",
    "l6_score_v2",
    "l7_score_v1",
    "l8_build_biofeature_map",
    "j6_overlap_join_points",
    "j6_overlap_join_bodies",
    "j7_liftover",
    "j11_nearest_concordance",
    "j12_gene_coverage",
    "f5_within_sd",
    "a1_keep_best",
    "a14_describe_distance",
    "w1_quantile_scale_10",
    "w1_quantile_scale_100",
    "w2_quantile_bins",
    "n3_variant_evidence",
    "s12_write_sorted",
    "s13_write_partitioned",
]


def run(spark: SparkSession, name: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").count()  # start the engine
    seconds = {}
    for name in names:
        seconds[name] = round(run(spark, name, folder), 3)
        print(name, seconds[name], file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
