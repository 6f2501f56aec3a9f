"""Time the headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Every job runs once to warm up and three times for its median. Inputs that are not part
of a job (the JSON Lines file, a loaded store, a stored table) are made beforehand.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

import workload  # noqa: E402
from pairloom.operators import conform, coverage, gaps  # noqa: E402
from pairloom.plans.coverage_report import write_coverage  # noqa: E402
from pairloom.plans.export import COMPRESSIONS, export_store  # noqa: E402
from pairloom.plans.load import load_files  # noqa: E402
from pairloom.session import configure  # noqa: E402
from pairloom.sources.pair_store import PairStore  # noqa: E402
from pairloom.streaming.ingest import load_stream  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def run_all(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    root = tempfile.mkdtemp(prefix="bench-")
    fresh = iter(range(10**6))

    def folder(name: str) -> str:
        return f"{root}/{name}-{next(fresh)}"

    def new_store() -> PairStore:
        return PairStore(spark, folder("store"))

    lines = workload.write_lines(workload.valid_lines(spark, SF_DIR), folder("valid"))
    mixed = workload.write_lines(workload.mixed_lines(spark, SF_DIR), folder("mixed"))
    store = new_store()
    rows = load_files(spark, [lines], store).inserted
    shard_size = -(-rows // 4)
    pairs = store.read()
    raw = spark.read.text(mixed)

    jobs = {
        "load_valid": lambda: load_files(spark, [lines], new_store()),
        "load_mixed": lambda: load_files(spark, [mixed], new_store()),
        "reload_all_skipped": lambda: load_files(spark, [lines], store),
        "stream_load": lambda: load_stream(spark, lines, new_store(), folder("checkpoint")),
        "coverage_long": lambda: run_all(coverage.coverage_long(pairs)),
        "coverage_file": lambda: write_coverage(spark, store, folder("out") + "/c.json"),
        "axis_domain": lambda: run_all(coverage.axis_counts(pairs, "domain")),
        "axis_capability": lambda: run_all(coverage.tag_counts(pairs)),
        "cross_domain_difficulty": lambda: run_all(
            coverage.cross_counts(pairs, "domain", "difficulty")
        ),
        "gap_cells": lambda: run_all(gaps.cell_gaps(pairs)),
        "next_targets": lambda: run_all(gaps.next_targets(pairs, 10)),
        "strict_report": lambda: run_all(conform.strict_violations(raw)),
    }
    for codec in COMPRESSIONS:
        jobs[f"export_{codec}"] = lambda codec=codec: export_store(
            store, folder("export"), shard_size, codec
        )

    seconds = {}
    for name, job in jobs.items():
        job()
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            job()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_median_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "rows": rows,
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
