"""Benchmark: ETL build plus every report and view at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {...}, "cold_sec",
"first_build_sec", "at_scale_sec", "sf"}.

``cold_sec`` is a first ETL build in a new JVM, over the smallest test tables (if
present); it also warms the JVM for the steps that ``queries`` times. ``etl_build`` is
the second build at the timed size, ``first_build_sec`` the first.
``etl_at_scale`` is the ETL with the broadcast and numbering bounds forced down, so
that it takes the plans a large input takes: shuffle lookups, ranged ids, a
rebalanced fact write. It is reported beside the total, not in it.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))

    from starmart.datasets import dataset_name, load_testdata
    from starmart.plans.etl import csv_roundtrip, row_counts
    from starmart.plans.marts import build_marts
    from starmart.plans.reports import DASHBOARD, REPORTS
    from starmart.plans.views import VIEWS
    from starmart.session import local_session
    from starmart.sources.staging import staging_submissions

    spark = local_session(cpus, shuffle_partitions=cpus, app="starmart-bench")
    times: dict[str, float] = {}
    errors: dict[str, str] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        try:
            out = fn()
        except Exception as exc:  # keep measuring the other steps; report the failure
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
            return None
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    # Warm the JVM (class loading, JIT of the generated code) outside the measured steps.
    cold = time.perf_counter()
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        warm = load_testdata(spark, warm_dir, dataset_name(warm_dir) + "-warmup")
        cold = time.perf_counter() - cold
        for report in {**REPORTS, **DASHBOARD}.values():
            report(warm).collect()
        build_marts(spark, warm)
        csv_roundtrip(spark, staging_submissions(spark, warm_dir), dataset_name(warm_dir) + "-warmup").write.format("noop").mode("overwrite").save()
    else:
        spark.read.parquet(f"{sf_dir}/region.parquet").collect()
        cold = None

    dataset = dataset_name(sf_dir) + "-bench"
    # The first build at this size still compiles code; the second is the one that counts.
    timed("etl_first_build", lambda: load_testdata(spark, sf_dir, dataset + "-first"))
    first = times.pop("etl_first_build", None)
    star = timed("etl_build", lambda: load_testdata(spark, sf_dir, dataset))
    if star is not None:
        for key, report in {**REPORTS, **DASHBOARD}.items():
            timed(key, lambda: report(star).collect())
        marts = timed("marts_build", lambda: build_marts(spark, star))
        if marts is not None:
            for key, view in VIEWS.items():
                timed(key, lambda: view(marts).collect())
        timed("etl_row_counts", lambda: row_counts(spark, star).collect())
    def csv_through():
        # A noop sink takes every column; a count would prune the parsing away.
        csv_roundtrip(spark, staging_submissions(spark, sf_dir), dataset).write.format("noop").mode("overwrite").save()

    timed("etl_csv_roundtrip", csv_through)
    timed(
        "etl_at_scale",
        lambda: load_testdata(spark, sf_dir, dataset + "-scale", broadcast_rows=1_000, rows_per_range=50_000),
    )
    at_scale = times.pop("etl_at_scale", None)

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    result = {
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold_sec": round(cold, 3) if cold else None,
        "first_build_sec": first,
        "at_scale_sec": at_scale,
        "sf": float(sf.group(1)) if sf else sf_dir,
    }
    if errors:
        result["errors"] = errors
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
