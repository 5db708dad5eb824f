"""

Prints one JSON line per case: median of three after one warm-up, seconds.
Inputs are derived from the test tables and written once to a scratch folder
given as the first argument (a fresh ``mktemp -d``).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from loadsmith.functions import rules  # noqa: E402
from loadsmith.functions.dates import run_date  # noqa: E402
from loadsmith.functions.keys import surrogate_key  # noqa: E402
from loadsmith.operators.lookup import existence_flag  # noqa: E402
from loadsmith.plans import standins as si  # noqa: E402
from loadsmith.plans import stg_employee  # noqa: E402
from loadsmith.session import local_session  # noqa: E402
from loadsmith.sources import incremental_scan, upsert_table, upsert_table_buckets  # noqa: E402


def timed(fn, runs=3):
    fn()
    times = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return round(statistics.median(times), 3)


def emit(case, **kw):
    print(json.dumps({"case": case, **kw}), flush=True)


def main():
    scratch = sys.argv[1]
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(8)
    noop = lambda df: df.write.format("noop").mode("overwrite").save()

    # 1. incremental scan at 1 / 10 / 50 % new rows; source sorted by the
    #    watermark and written with small row groups so min/max stats can skip.
    src_path = f"{scratch}/dsv"
    (si.data_src_val(si.table(spark, sf, "events")).orderBy("LAST_UPDT_TS").coalesce(1)
     .write.option("parquet.block.size", 64 * 1024).parquet(src_path))
    src = spark.read.parquet(src_path)
    total = src.count()
    for pct in (1, 10, 50):
        bound = src.selectExpr(f"percentile_approx(LAST_UPDT_TS, {1 - pct / 100}) AS b") \
                   .first()["b"].strftime("%Y-%m-%d %H:%M:%S.%f")
        pushed = incremental_scan(src, src.limit(0), "LAST_UPDT_TS", bound=bound)
        opaque = src.where(F.col("LAST_UPDT_TS").cast("string") > F.lit(bound))
        emit("incremental_scan", new_pct=pct, rows=pushed.count(), of=total,
             pushed_sec=timed(lambda: noop(pushed)), not_pushed_sec=timed(lambda: noop(opaque)))

    # 2. keyed upsert of 1 % changed keys: whole snapshot vs touched buckets.
    li = si.table(spark, sf, "lineitem")
    rows = li.select(surrogate_key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("K"), "l_orderkey",
                     "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
    changed = rows.where(F.col("l_orderkey") % 100 == 0).withColumn("l_quantity", F.col("l_quantity") + 1)
    upsert_table(rows, "bench_snap", "K", f"{scratch}/snap", run_id="0")
    upsert_table_buckets(rows, "bench_bkt", "K", f"{scratch}/bkt", buckets=64)
    runs = iter(range(1, 100))
    emit("keyed_upsert", target_rows=rows.count(), batch_rows=changed.count(),
         snapshot_sec=timed(lambda: upsert_table(changed, "bench_snap", "K", f"{scratch}/snap",
                                                 run_id=str(next(runs)))),
         buckets_sec=timed(lambda: upsert_table_buckets(changed, "bench_bkt", "K",
                                                         f"{scratch}/bkt", buckets=64)))

    # a small batch against a table with many buckets touches few of them
    few = rows.where(F.col("l_orderkey") % 10000 == 0).withColumn("l_quantity", F.col("l_quantity") + 2)
    upsert_table_buckets(rows, "bench_bkt1k", "K", f"{scratch}/bkt1k", buckets=1024)
    emit("keyed_upsert_small_batch", target_rows=rows.count(), batch_rows=few.count(), buckets=1024,
         snapshot_sec=timed(lambda: upsert_table(few, "bench_snap", "K", f"{scratch}/snap",
                                                 run_id=str(next(runs)))),
         buckets_sec=timed(lambda: upsert_table_buckets(few, "bench_bkt1k", "K",
                                                         f"{scratch}/bkt1k")))

    # bytes that the bucket upsert writes, for batches of growing size
    import pathlib

    for step in (60_000, 6_000, 600, 60):
        part = rows.where(F.col("l_orderkey") % step == 0).withColumn("l_quantity", F.col("l_quantity") + 3)
        began = time.time()
        upsert_table_buckets(part, "bench_bkt1k", "K", f"{scratch}/bkt1k")
        files = [f for f in pathlib.Path(f"{scratch}/bkt1k").rglob("*.parquet")]
        emit("bucket_upsert_bytes", batch_rows=part.count(), written=sum(f.stat().st_size for f in files if f.stat().st_mtime >= began),
             table=sum(f.stat().st_size for f in files))

    # 3. existence flag: broadcast by file size vs shuffle join.
    emp = si.employees(si.table(spark, sf, "orders"))

    def flag(threshold):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", threshold)
        return timed(lambda: noop(existence_flag(emp, "EMPLOYEE_ID", emp, "MANAGER_ID", name="M")))

    emit("existence_flag", broadcast_sec=flag("64m"), shuffle_sec=flag("-1"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4m")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "32m")

    # 4. wide projection: label filter only vs label + pushable raw filter, stored source.
    emp_path = f"{scratch}/employees"
    emp.write.parquet(emp_path)
    stored = spark.read.parquet(emp_path)
    today = run_date(si.RUN_STD)

    def label_only():
        full = stg_employee.build(stored, si.RUN_STD, keep_invalid=True, cast=False)
        return full.where((F.col("EMPLOYEE_STATUS") == "ACTIVE") & (F.col("DATA_QUALITY_FLAG") == "VALID"))

    emit("wide_projection", rows=stored.count(),
         label_filter_sec=timed(lambda: noop(label_only())),
         pushable_filter_sec=timed(lambda: noop(stg_employee.build(stored, si.RUN_STD, cast=False))),
         pushable_rows=stored.where(rules.active_valid_pushable(today=today)).count())
    spark.stop()


if __name__ == "__main__":
    main()
