"""Run the production path end to end and time each layer.

    python tools/pipeline_run.py --sf /root/testdata/sf0.1 --out "$(mktemp -d /tmp/run-XXXXXX)"

Writes two daily snapshots of the six raw tables (derived from the driver
tables: day 1 an older copy of a third of the keys, day 2 everything), then
runs ``build_all``: raw load (decode + keep-latest, written once), staging
views, the four marts written month-partitioned, and the 52 data tests over
the written raw tables. Prints one JSON line with seconds per step.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--out", required=True, help="scratch folder (shared storage on a cluster)")
    ap.add_argument("--cpus", type=int, default=8)
    args = ap.parse_args()

    from pyspark.sql import functions as F

    from reelstat import config as C
    from reelstat.plans import pipeline
    from reelstat.session import build_session
    from reelstat.sources import adapters as A
    from reelstat.sources import raw as R

    spark = build_session(master=f"local[{args.cpus}]", app="reelstat-pipeline", shuffle_partitions=args.cpus,
                          extra={"spark.driver.memory": "8g", "spark.checkpoint.dir": f"{args.out}/checkpoints"})
    spark.sparkContext.setLogLevel("ERROR")
    snaps, day1, day2 = f"{args.out}/snapshots", dt.date(2026, 3, 27), dt.date(2026, 3, 28)
    timings = {}

    t0 = time.perf_counter()
    for table, build in A.RAW_ADAPTERS.items():
        df = build(spark, args.sf)
        key = C.PRIMARY_KEYS[table][0]
        R.write_snapshot(df.filter(F.col(key) % 3 == 0).withColumn(C.INGESTION_DATE, F.lit("1000-01-01")),
                         snaps, table, day1)
        R.write_snapshot(df, snaps, table, day2)
    timings["write_snapshots"] = time.perf_counter() - t0

    cfg = C.BuildConfig(warehouse=f"{args.out}/warehouse", snapshots=snaps, as_of=dt.date(2026, 4, 1))
    t0 = time.perf_counter()
    reports = R.load_raw_layer(spark, cfg, run_date=day2, max_parallel=3)
    timings["raw_layer"] = time.perf_counter() - t0

    t0 = time.perf_counter()
    result = pipeline.build_all(spark, C.BuildConfig(warehouse=cfg.warehouse, as_of=cfg.as_of),
                                run_date=day2, raise_on_test_failure=False)
    timings["marts_and_tests"] = time.perf_counter() - t0
    print(json.dumps({"sf": args.sf, "seconds": {k: round(v, 2) for k, v in timings.items()},
                      "raw_rows": {r.table: r.rows for r in reports},
                      "failing_rules": sum(1 for q in result.quality if q["failing_rows"] > 0)}))
    spark.stop()


if __name__ == "__main__":
    main()
