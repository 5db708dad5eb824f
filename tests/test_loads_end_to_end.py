"""load() on catalog tables (two runs, recorded watermark) equals the registered queries."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from loadsmith import schemas
from loadsmith.plans import customer_data_load, customer_load
from loadsmith.plans import standins as si
from loadsmith.operators import DataCheckError
from loadsmith.plans import validation_stage
from loadsmith.registry import plan_queries as pq
from loadsmith.sources import upsert_table
from tests.conftest import plan_text

TS = dt.datetime

SF = "/root/testdata/sf0.001"


def _same(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_customer_data_load_two_loads(spark, scratch):
    first, second, addr = pq._cdl_inputs(spark, SF)
    customer_data_load.load(first, addr, "t_cdl", f"{scratch}/t_cdl", as_of=si.RUN_MASTER_1)
    assert spark.table("t_cdl").schema == schemas.CUSTOMER_DATA_LOAD
    customer_data_load.load(second, addr, "t_cdl", f"{scratch}/t_cdl", as_of=si.RUN_MASTER_2)
    _same(spark.table("t_cdl"), pq.q_customer_data_load(spark, SF))


def test_customer_load_two_loads(spark, scratch):
    first, second, dim = pq._cl_inputs(spark, SF)
    customer_load.load(first, dim, "t_cl", f"{scratch}/t_cl", as_of="2001-01-20 12:00:00")
    customer_load.load(second, dim, "t_cl", f"{scratch}/t_cl", as_of=si.RUN_CUSTOMER)
    _same(spark.table("t_cl"), pq.q_customer_load_decimal(spark, SF))
    assert spark.table("t_cl").schema == schemas.CUSTOMER_LOAD
    # a third run with nothing new changes nothing
    from loadsmith.sources.sinks import table_location
    before = spark.table("t_cl").select("CUSTOMER_ID", "UPDATED_DATE").collect()
    location = table_location(spark, "t_cl")
    customer_load.load(second, dim, "t_cl", f"{scratch}/t_cl", as_of="2001-09-01 00:00:00")
    assert table_location(spark, "t_cl") == location          # no new version written
    after = spark.table("t_cl").select("CUSTOMER_ID", "UPDATED_DATE").collect()
    assert sorted(map(tuple, before)) == sorted(map(tuple, after))
    assert spark.table("t_cl").where(F.col("DW_LOAD_TIMESTAMP") == F.lit("2001-09-01").cast("timestamp_ntz")).count() == 0


def test_validation_stage_bucket_load_equals_query(spark, scratch):
    from loadsmith.plans import validation_stage

    events = si.table(spark, SF, "events")
    cut = F.lit(si.VAL_CUT).cast("timestamp_ntz")
    first = si.data_src_val(events).where(F.col("VAL_EXEC_START_TS") <= cut)
    second = si.data_src_val(events, modified_before=si.VAL_CUT)
    validation_stage.load(first, "t_vb", f"{scratch}/t_vb", as_of=si.RUN_VAL_1, buckets=16)
    validation_stage.load(second, "t_vb", f"{scratch}/t_vb", as_of=si.RUN_VAL_2, buckets=16)
    spark.catalog.refreshTable("t_vb")
    declared = [F.col(f.name).cast(f.dataType) for f in schemas.VALIDATION_STAGE.fields]
    _same(spark.table("t_vb").drop("_key_bucket"), pq.q_validation_stage(spark, SF).select(*declared))


def test_duplicate_batch_keys_fail_or_keep_latest(spark, scratch):
    import datetime as dt
    from decimal import Decimal

    import pytest

    from loadsmith import schemas
    from loadsmith.operators import DataCheckError
    from loadsmith.plans import validation_stage

    def row(vid, ts, user):
        return (vid, 1, 1, 1, "OK", ts, ts, Decimal("1.000"), "t", 1, 1, ts, user)

    src = spark.createDataFrame([row(1, dt.datetime(2024, 1, 1), "old"), row(1, dt.datetime(2024, 1, 2), "new"),
                                 row(2, dt.datetime(2024, 1, 1), "x")], schemas.DATA_SRC_VAL)
    with pytest.raises(DataCheckError):
        validation_stage.load(src, "t_dup", f"{scratch}/t_dup", as_of="2024-01-03 00:00:00")
    validation_stage.load(src, "t_dup2", f"{scratch}/t_dup2", as_of="2024-01-03 00:00:00", dedupe=True)
    out = {r.DATA_SRC_VAL_ID: r.LAST_UPDT_USER_ID for r in spark.table("t_dup2").collect()}
    assert out == {1: "new", 2: "x"}


def _val(vid, t, rule=1, user="u"):
    from decimal import Decimal

    return (vid, 1, rule, 1, "OK", t, t, Decimal("1.000"), "t", 1, 1, t, user)


def _scratch_folders(spark):
    from loadsmith.session import ensure_checkpoint_dir

    return {f for f in os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:")) if "loadsmith-" in f}


def test_a_load_leaves_no_scratch(spark, scratch):
    before = _scratch_folders(spark)
    src = spark.createDataFrame([_val(1, TS(2024, 1, 1))], schemas.DATA_SRC_VAL)
    for i in (1, 2):
        validation_stage.load(src, "t_clean", f"{scratch}/t", as_of="2024-01-03 00:00:00")
        validation_stage.load(src, "t_cleanb", f"{scratch}/tb", as_of="2024-01-03 00:00:00", buckets=4)
    assert _scratch_folders(spark) == before


def test_load_prunes_partitions_and_looks_back(spark, scratch):
    rows = [_val(i, TS(2024, 1, 1 + i, 12)) for i in range(6)]
    (spark.createDataFrame(rows, schemas.DATA_SRC_VAL).withColumn("LOAD_DAY", F.to_date("LAST_UPDT_TS"))
     .write.partitionBy("LOAD_DAY").parquet(f"{scratch}/src"))
    src = spark.read.parquet(f"{scratch}/src")
    first = src.where("LOAD_DAY <= '2024-01-04'")
    validation_stage.load(first, "t_part", f"{scratch}/t", as_of="2024-01-05 00:00:00", partition_col="LOAD_DAY")
    late = spark.createDataFrame([_val(90, TS(2024, 1, 4, 11))], schemas.DATA_SRC_VAL) \
        .withColumn("LOAD_DAY", F.to_date("LAST_UPDT_TS"))
    validation_stage.load(src.unionByName(late), "t_part", f"{scratch}/t", as_of="2024-01-09 00:00:00",
                          partition_col="LOAD_DAY", lookback="2 HOUR")
    assert sorted(r.DATA_SRC_VAL_ID for r in spark.table("t_part").collect()) == [0, 1, 2, 3, 4, 5, 90]
    batch = validation_stage.build(src, first, bound="2024-01-04 12:00:00", partition_col="LOAD_DAY")
    assert "PartitionFilters: [isnotnull(LOAD_DAY" in plan_text(batch)


def test_load_by_name_and_path(spark, scratch):
    src = spark.createDataFrame([_val(1, TS(2024, 1, 1))], schemas.DATA_SRC_VAL)
    src.write.parquet(f"{scratch}/src")
    src.write.mode("overwrite").saveAsTable("t_named_source")
    validation_stage.load(f"{scratch}/src", "t_by_path", f"{scratch}/a", spark=spark, as_of="2024-01-03 00:00:00")
    validation_stage.load("t_named_source", "t_by_name", f"{scratch}/b", spark=spark, as_of="2024-01-03 00:00:00")
    assert spark.table("t_by_path").count() == spark.table("t_by_name").count() == 1


def test_orphans_and_missing_keys_fail_the_load_when_asked(spark, scratch):
    first, second, addr = pq._cdl_inputs(spark, SF)
    with pytest.raises(DataCheckError, match="orphan"):
        customer_data_load.load(first, addr, "t_orphan", f"{scratch}/o", as_of=si.RUN_MASTER_1, require_addresses=True)
    raw, _, dim = pq._cl_inputs(spark, SF)
    nameless = raw.withColumn("CUSTOMER_ID", F.when(F.col("CUSTOMER_ID") % 2 == 0, F.col("CUSTOMER_ID")))
    for buckets in (None, 4):
        with pytest.raises(DataCheckError, match="null key"):
            customer_load.load(nameless, dim, "t_nokey", f"{scratch}/k", as_of=si.RUN_CUSTOMER, require_keys=True, buckets=buckets)
    assert not spark.catalog.tableExists("t_orphan") and not spark.catalog.tableExists("t_nokey")


def test_rollback_reloads_the_skipped_rows(spark, scratch):
    """The watermark belongs to a version: after pointing the table back, its rows decide."""
    from loadsmith.sources.sinks import stored_watermark, table_location

    one = spark.createDataFrame([_val(1, TS(2024, 1, 1))], schemas.DATA_SRC_VAL)
    two = spark.createDataFrame([_val(1, TS(2024, 1, 1)), _val(2, TS(2024, 1, 9))], schemas.DATA_SRC_VAL)
    validation_stage.load(one, "t_back", f"{scratch}/t", as_of="2024-01-02 00:00:00")
    old = table_location(spark, "t_back")
    validation_stage.load(two, "t_back", f"{scratch}/t", as_of="2024-01-10 00:00:00")
    assert stored_watermark(spark, "t_back", "LAST_UPDT_TS") == "2024-01-09 00:00:00"
    spark.sql(f"ALTER TABLE t_back SET LOCATION '{old}'")
    spark.sql("REFRESH TABLE t_back")
    assert stored_watermark(spark, "t_back", "LAST_UPDT_TS") is None
    validation_stage.load(two, "t_back", f"{scratch}/t", as_of="2024-01-11 00:00:00")
    assert sorted(r.DATA_SRC_VAL_ID for r in spark.table("t_back").collect()) == [1, 2]


def test_large_numeric_watermarks_are_exact(spark, scratch):
    from loadsmith.sources.sinks import stored_watermark

    big = 2 ** 60
    for n in (big, big + 1):
        upsert_table(spark.createDataFrame([(n, n)], "k long, wm long"), "t_big", "k", f"{scratch}/t", watermark="wm")
    assert stored_watermark(spark, "t_big", "wm") == str(big + 1)
