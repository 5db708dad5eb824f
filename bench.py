"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and executed in full through the ``noop`` sink (every
row computed, nothing collected to the driver).  Plan building is included:
it runs the size probes and checkpoints the plans rely on.  One warm-up, then
the median of three runs.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loadsmith.registry import queries  # noqa: E402
from loadsmith.session import local_session  # noqa: E402

HEADLINE = [
    "emp_load",            # lookup left join with defaults
    "stg_employee",        # wide projection (35 derived columns) + existence flag + label filter
    "customer_data_load",  # two incremental runs + address lookup + filter + upsert
    "customer_load",       # two incremental runs + country lookup + upsert
    "validation_stage",    # two incremental runs + change tag + upsert
    "watermark_scan",      # incremental scan
    "keyed_upsert",        # keyed upsert on events
    "existence_flag",      # existence flag
    "lookup_raw_code_default",
    "quality_flags",
    "commission_tier",     # column rules over lineitem (largest table)
    "check_relationships",
]


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")),
                          app="loadsmith-bench")
    registry = queries()
    times = {}
    for name in names:
        fn = registry[name]
        run_once(spark, fn, sf_dir)                      # warm-up
        times[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(3)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum of median seconds per headline query (build + full execution)",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
