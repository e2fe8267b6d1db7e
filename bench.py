"""Times the headline queries; prints one JSON line.

Lines of the real feeds are written as text once, outside the measured time; then each feed is
scanned, checked, translated and rendered, its exceptions are listed and its audit is made; two feeds
are run as whole jobs. Every query runs once to warm up and then three times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from feedloom.layouts import FEEDS
from feedloom.operators import audit
from feedloom.operators.exceptions import exception_rows
from feedloom.plans import job, queries
from feedloom.plans.transform import outcomes, transform
from feedloom.session import tune
from feedloom.sources.lines import read_lines

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
JOBS = ("position_balance", "memo_position")
TABLE_QUERIES = ("fw_classify", "fw_route_accepted", "fw_route_rejected", "fw_render_pipe",
                 "fw_exceptions", "fw_typed_structs", "fw_roundtrip_sorted", "audit_counts",
                 "audit_values", "audit_report_long", "audit_report_tabular", "destination_names")


def main() -> None:
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
             .config("spark.sql.shuffle.partitions", CPUS)
             .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.checkpoint.dir", f"{work}/shared")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    times: dict[str, float] = {}
    speed: dict[str, int] = {}

    def timed(name, run) -> None:
        seconds = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            run()
            seconds.append(time.perf_counter() - start)
        times[name] = round(statistics.median(seconds[1:]), 3)

    def drain(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    for name, feed in FEEDS.items():
        path = f"{work}/{name}"
        queries.feed_lines(spark, SF_DIR, feed).select("value").write.text(path)
        lines = read_lines(spark, path)
        rows, counted = transform(lines, feed), outcomes(lines, feed)
        inputs = job.Inputs().filled(spark, feed)
        timed(f"{name}_transform", lambda: drain(rows))
        speed[name] = round(lines.count() / times[f"{name}_transform"] / int(CPUS))
        timed(f"{name}_exceptions", lambda: drain(exception_rows(rows)))
        timed(f"{name}_audit", lambda: audit.tabular_report(job.audit_report(counted, inputs, name)).collect())
    for name in JOBS:
        timed(f"{name}_job", lambda: job.run_feed(
            spark, name, f"{work}/{name}", f"{work}/out-{name}", mode="overwrite"))
    registered = queries.all_queries()
    for name in TABLE_QUERIES:
        timed(name, lambda: drain(registered[name](spark, SF_DIR)))
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                      "cpus": int(CPUS), "transform_lines_per_second_and_core": speed}))
    spark.stop()


if __name__ == "__main__":
    main()
