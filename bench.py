"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores. Every query runs to the end once, into a sink
that keeps nothing, in one session that has run all of them on the smallest tables before.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mailprep.plans.queries import QUERIES  # noqa: E402

HEADLINES = [
    "s1_read_delimited", "s3_write_snapshot", "c1_drop_all_null_columns", "j1_join_metadata", "j1_join_metadata_outer",
    "t1_strip_flexible_reply_header", "t8_strip_known_reply_headers", "t10_apply_discard_patterns",
    "t11_remove_sensitive_lines", "t12_redact", "t14_last_valid_sentence", "t15_clean_text", "t15_clean_pages",
    "t16_filter_short", "l1_detect_language", "l2_language_model", "l4_language_distribution", "p3_duplicate_rows",
    "p4_describe_numeric", "p5_describe_categorical", "p6_distinct_counts", "p8_value_counts_orders", "p9_profile",
    "f1_search_regex", "f7_facet_counts", "f8_explore", "f9_record_at", "f10_match_spans_literal", "d4_split_dataset",
    "d5_dataset_stats", "d6_class_weights", "m1_train_classifier", "m4_metrics_macro", "prepare_mails",
    "complaints_by_priority",
]


def run(name: str, spark: SparkSession, sf_dir: str) -> None:
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    seconds, failed = {}, {}
    for directory in [small, sf_dir] if os.path.isdir(small) else [sf_dir]:
        for name in names:
            start = time.perf_counter()
            try:
                run(name, spark, directory)
            except Exception as e:  # one query that fails leaves the others' figures alone
                failed[name] = str(e).splitlines()[0][:300]
                print(f"{name} on {directory}: {failed[name]}", file=sys.stderr)
                continue
            if directory == sf_dir:
                seconds[name] = round(time.perf_counter() - start, 3)
                print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(json.dumps({"metric": "total time of the headline queries", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
                      "cpus": int(cpus), **({"failed": failed} if failed else {})}))
    spark.stop()
    if failed:
        sys.exit(1)


if __name__ == "__main__":
    main()
