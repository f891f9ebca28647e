"""Time the catalog's headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the scale.
Every query is run to its end over whole tables, without keeping the result.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog.queries import CATALOG  # noqa: E402

HEADLINE = (
    "verdict_report", "validation", "verdicts_strict", "verdicts_hot_domains", "cached_flag",
    "route_sendable", "lookup_worklist", "array_fanout", "normalize_split", "filler_flags",
    "typo_suggest", "typo_long_list", "edit_distance", "mail_status", "snapshot_latest",
    "domain_age", "extracted_contacts", "stream_validate",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("postsift-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="postsift-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Warm-up: compile a validation at the size that is measured, and keep nothing.
    CATALOG["verdicts"].spark(spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        CATALOG[name].spark(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
