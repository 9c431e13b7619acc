"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to the ``noop`` sink (full execution, no collect); the value
per query is the median of $BENCH_RUNS warm runs. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = ["type_conversion", "null_fill", "dedup_mark", "dedup_latest", "enrich_full",
            "monthly_store_sales", "sales_lead_lag", "merge_upsert", "parse_json",
            "raw_archive_latest"]


def main() -> None:
    from kassa.session import get_session
    from kassa.plans.queries import QUERIES
    scratch = tempfile.mkdtemp(prefix="kassa-bench-")
    spark = get_session(f"local[{CPUS}]", app="kassa-bench",
                        shuffle_partitions=int(CPUS) * 2,
                        extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g"),
                               "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                               "spark.local.dir": os.path.join(scratch, "local")})
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))

    def run(name: str) -> float:
        t = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    run("scan_parquet")  # warm the JVM, file listing and code caches
    results, errors = {}, {}
    for name in HEADLINE:
        try:
            times = [run(name) for _ in range(RUNS)]
            results[name] = round(statistics.median(times), 3)
        except Exception as e:  # noqa: BLE001 - record and go on (e.g. MERGE
            # rejects the smallest tables, which repeat merge keys)
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    try:
        results["streaming_ingest"] = round(_bench_stream(spark, scratch), 3)
    except Exception as e:  # noqa: BLE001
        errors["streaming_ingest"] = f"{type(e).__name__}: {str(e)[:200]}"
    total = round(sum(results.values()), 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    out = {"metric": "sum_of_median_query_seconds", "value": total, "unit": "sec",
           "queries": results, "sf": sf, "cpus": int(CPUS), "runs": RUNS}
    if errors:
        out["errors"] = errors
    print(json.dumps(out), flush=True)
    spark.stop()
    shutil.rmtree(scratch, ignore_errors=True)


def _bench_stream(spark, scratch: str) -> float:
    """Drain the encoded records of the whole staging table through the
    streaming ingest (decode, parse, archive upsert, staging write)."""
    from kassa.plans.queries import staged
    from kassa.sources import testmap
    from kassa.streaming.ingest import start_ingest
    src = os.path.join(scratch, "stream-src")
    testmap.envelopes(staged(spark, SF_DIR)).write.mode("overwrite").json(src)
    t = time.perf_counter()
    q = start_ingest(spark, src, os.path.join(scratch, "archive"), os.path.join(scratch, "stage"),
                     os.path.join(scratch, "quarantine"), os.path.join(scratch, "stream-ckpt"))
    q.awaitTermination()
    return time.perf_counter() - t


if __name__ == "__main__":
    main()
