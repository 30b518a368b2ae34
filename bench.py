"""Time the full build over deliveries derived from the tables at ``BENCH_SF_DIR``.

Writing the input deliveries is not timed. The build runs twice: ``cold`` includes compiling the
generated code, the headline value is the second run. Every build reads the delivery files anew and
writes all its tables.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from checks import fixture
from checks.queries import queries
from feedgate.plans.build import build
from feedgate.plans.workspace import Workspace

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Operators timed on their own, over the stages they build on.
SINGLE = (
    "normalize",
    "token_patient_ambiguous",
    "contract_measures",
    "global_key_dupes",
    "same_delivery_conflicts",
    "row_disposition",
    "dedup_rank",
    "version_rank",
    "silver_line",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("feedgate-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", CPUS)
        # Small tables here: let adaptive execution split a month between the cores.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # A build generates more classes than the default cache keeps.
        .config("spark.sql.codegen.cache.maxEntries", "1000")
        # Write partitions side by side instead of sorting the wide rows first.
        .config("spark.sql.maxConcurrentOutputFileWriters", "32")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    spark = session()
    deliveries, graph = fixture.write_deliveries(spark, SF_DIR, Workspace(spark, "bench").path("in"))
    contract = fixture.contract(spark, SF_DIR)
    times: dict[str, float] = {}
    for run in ("cold", "build"):
        out = Workspace(spark, "bench").path("out")
        steps: dict[str, float] = {}
        started = time.monotonic()
        built = build(spark, deliveries, graph, out, contract, report=steps.__setitem__)
        times[run] = time.monotonic() - started
    times |= {f"build.{name}": seconds for name, seconds in steps.items()}
    totals = built.totals().first()

    registered = queries()
    registered["silver_line"](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    for name in SINGLE:
        started = time.monotonic()
        registered[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times[name] = time.monotonic() - started
    print(
        json.dumps(
            {
                "metric": "full build: deliveries to gated, checked and published silver tables",
                "value": round(times["build"], 2),
                "unit": "sec",
                "queries": {name: round(seconds, 2) for name, seconds in times.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "silver_lines": totals.silver_lines,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
