"""Registered queries that run the five load plans end to end on the test tables.

Incremental plans run twice: a first load of the rows up to a cut time, then
a second run over the whole (partly modified) source against that target,
applied with the keyed upsert.  Each query returns the table state after the
last run.  As in a real load, the first run's target and the second run's
batch are written once (under ``spark.checkpoint.dir``) and read back, so the
watermark bound, the change tag, the key checks and the union all read stored
rows instead of recomputing them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsmith import schemas
from loadsmith.scratch import materialize, scratch_path
from loadsmith.operators.lookup import lookup_join
from loadsmith.operators.upsert import upsert_frame
from loadsmith.plans import (
    customer_data_load, customer_load, emp_load, stg_employee, validation_stage,
)
from loadsmith.plans import standins as si
from loadsmith.sources.file_marks import incremental_files
from loadsmith.sources.key_groups import GROUP_COL, merge_groups, summary_table
from loadsmith.operators.checks import DataCheckError
from loadsmith.sources.sinks import BUCKET_COL, table_location, upsert_table, write_bucketed
from loadsmith.sources.tables import watermark_bound


def q_emp_load(spark: SparkSession, sf: str) -> DataFrame:
    return emp_load.build(si.emp(si.table(spark, sf, "customer")),
                          si.dept(si.table(spark, sf, "nation")), as_of=si.RUN_EMP, cast=False)


def q_stg_employee(spark: SparkSession, sf: str) -> DataFrame:
    return stg_employee.build(si.employees(si.table(spark, sf, "orders")), as_of=si.RUN_STD, cast=False)


def q_stg_employee_all_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The staging frame before the ACTIVE-and-VALID filter: every row with its flags."""
    return stg_employee.build(si.employees(si.table(spark, sf, "orders")), as_of=si.RUN_STD,
                              keep_invalid=True, cast=False)


def q_stg_employee_decimal(spark: SparkSession, sf: str) -> DataFrame:
    """The staging plan as it loads: sources cast to their declared types, target in its own."""
    return stg_employee.build(si.employees(si.table(spark, sf, "orders")), as_of=si.RUN_STD)


def _cdl_inputs(spark, sf):
    orders = si.table(spark, sf, "orders")
    first = si.customer_master(orders).where(
        F.col("LAST_MODIFIED_DATE") <= F.lit(si.MASTER_CUT).cast("timestamp_ntz"))
    second = si.customer_master(orders, modified_before=si.MASTER_CUT)
    return first, second, si.address_master(si.table(spark, sf, "customer"))


def q_customer_data_load(spark: SparkSession, sf: str) -> DataFrame:
    first, second, addr = _cdl_inputs(spark, sf)
    target = materialize(customer_data_load.build(first, addr, None, si.RUN_MASTER_1, cast=False), "target")
    batch = materialize(customer_data_load.build(second, addr, target, si.RUN_MASTER_2, cast=False), "batch")
    return upsert_frame(target, batch, schemas.KEYS["customer_data_load"], check_schema=True)


def _cl_inputs(spark, sf):
    customer, orders = si.table(spark, sf, "customer"), si.table(spark, sf, "orders")
    first = si.customer_raw(customer, orders).where(
        F.col("UPDATED_DATE") <= F.lit(si.CUSTOMER_CUT).cast("timestamp_ntz"))
    second = si.customer_raw(customer, orders, modified_before=si.CUSTOMER_CUT)
    dim = si.dim_country(si.table(spark, sf, "nation"), si.table(spark, sf, "region"))
    return first, second, dim


def q_customer_load(spark: SparkSession, sf: str, cast: bool = False) -> DataFrame:
    first, second, dim = _cl_inputs(spark, sf)
    target = materialize(customer_load.build(first, dim, None, si.RUN_CUSTOMER_1, cast=cast), "target")
    batch = materialize(customer_load.build(second, dim, target, si.RUN_CUSTOMER, cast=cast), "batch")
    return upsert_frame(target, batch, schemas.KEYS["customer_load"])


def q_customer_load_decimal(spark: SparkSession, sf: str) -> DataFrame:
    """The two customer loads on declared types."""
    return q_customer_load(spark, sf, cast=True)


def _val_inputs(spark, sf):
    events = si.table(spark, sf, "events")
    first = si.data_src_val(events).where(
        F.col("VAL_EXEC_START_TS") <= F.lit(si.VAL_CUT).cast("timestamp_ntz"))
    return first, si.data_src_val(events, modified_before=si.VAL_CUT)


def val_first_run(spark, sf) -> DataFrame:
    return validation_stage.build(_val_inputs(spark, sf)[0], None, si.RUN_VAL_1, cast=False)


def val_second_batch(spark, sf, target: DataFrame, audit: bool = False) -> DataFrame:
    return validation_stage.build(_val_inputs(spark, sf)[1], target, si.RUN_VAL_2, audit=audit, cast=False)


def q_validation_stage(spark: SparkSession, sf: str) -> DataFrame:
    target = materialize(val_first_run(spark, sf), "target")
    batch = materialize(val_second_batch(spark, sf, target), "batch")
    return upsert_frame(target, batch, [validation_stage.KEY])


# --- the writers: real loads into catalog tables, read back ----------------------

def _fresh(name: str) -> str:
    return f"loadsmith_{name}_{uuid.uuid4().hex[:12]}"


def _read_back(spark, table: str) -> DataFrame:
    """The table's rows, from its files; its catalog entry goes, so that runs leave none."""
    rows = spark.read.schema(spark.table(table).schema).parquet(table_location(spark, table))
    spark.sql(f"DROP TABLE {table}")
    return rows


def q_full_rebuild_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Two full rebuilds of the employee table; the second replaces the first."""
    table, root = _fresh("emp"), scratch_path(spark, "emp")
    employees, dept = si.emp(si.table(spark, sf, "customer")), si.dept(si.table(spark, sf, "nation"))
    emp_load.load(employees.where("EMPNO % 2 = 0"), dept, table, si.RUN_STD, root=root)
    emp_load.load(employees, dept, table, si.RUN_EMP, root=root)
    return _read_back(spark, table)


def q_first_load_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The first load of a table that does not exist yet."""
    table = _fresh("val")
    validation_stage.load(_val_inputs(spark, sf)[0], table, scratch_path(spark, "val"), si.RUN_VAL_1)
    return _read_back(spark, table)


def q_snapshot_upsert_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Two customer master loads by new table versions."""
    table, root = _fresh("cdl"), scratch_path(spark, "cdl")
    first, second, addr = _cdl_inputs(spark, sf)
    customer_data_load.load(first, addr, table, root, si.RUN_MASTER_1)
    customer_data_load.load(second, addr, table, root, si.RUN_MASTER_2)
    return _read_back(spark, table)


def q_bucket_upsert_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Two validation loads into a table of key buckets."""
    table, root = _fresh("valb"), scratch_path(spark, "valb")
    first, second = _val_inputs(spark, sf)
    validation_stage.load(first, table, root, si.RUN_VAL_1, buckets=16)
    validation_stage.load(second, table, root, si.RUN_VAL_2, buckets=16)
    return _read_back(spark, table).drop(BUCKET_COL)


def q_file_pruned_upsert_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Two validation loads into a table of key groups; the second rewrites the groups with matching keys."""
    table, root = _fresh("valg"), scratch_path(spark, "valg")
    first, second = _val_inputs(spark, sf)
    validation_stage.load(first, table, root, si.RUN_VAL_1, rows_per_group=1_000)
    validation_stage.load(second, table, root, si.RUN_VAL_2)
    spark.sql(f"DROP TABLE {summary_table(table)}")
    return _read_back(spark, table).drop(GROUP_COL)


def q_tagged_upsert_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Two validation loads by new table versions; the second reads the target once, for tag and upsert."""
    table, root = _fresh("valt"), scratch_path(spark, "valt")
    first, second = _val_inputs(spark, sf)
    validation_stage.load(first, table, root, si.RUN_VAL_1)
    validation_stage.load(second, table, root, si.RUN_VAL_2)
    return _read_back(spark, table)


def q_skip_unchanged_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Two customer master loads; the second scans every row again and writes only those that differ."""
    table, root = _fresh("cdlu"), scratch_path(spark, "cdlu")
    first, second, addr = _cdl_inputs(spark, sf)
    customer_data_load.load(first, addr, table, root, si.RUN_MASTER_1)
    customer_data_load.load(second, addr, table, root, si.RUN_MASTER_2, lookback="100000 DAYS", skip_unchanged=True)
    return _read_back(spark, table)


def q_delete_invalid_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Two customer master loads; customers that were suspended in between leave the table."""
    table, root = _fresh("cdld"), scratch_path(spark, "cdld")
    first, second, addr = _cdl_inputs(spark, sf)
    customer_data_load.load(first, addr, table, root, si.RUN_MASTER_1)
    customer_data_load.load(second, addr, table, root, si.RUN_MASTER_2, delete_invalid=True)
    return _read_back(spark, table)


def drifted(batch: DataFrame) -> dict[str, DataFrame]:
    """A batch with each kind of schema change."""
    return {"added column": batch.withColumn("EXTRA", F.lit(1)), "missing column": batch.drop("EMAIL"),
            "other name": batch.withColumnRenamed("EMAIL", "MAIL"), "other order": batch.select(*reversed(batch.columns)),
            "other type": batch.withColumn("CUSTOMER_ID", F.col("CUSTOMER_ID").cast("string"))}


def q_delete_invalid_buckets_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """As ``delete_invalid_roundtrip``, in a table of key buckets."""
    table, root = _fresh("cdlb"), scratch_path(spark, "cdlb")
    first, second, addr = _cdl_inputs(spark, sf)
    customer_data_load.load(first, addr, table, root, si.RUN_MASTER_1, buckets=64)
    customer_data_load.load(second, addr, table, root, si.RUN_MASTER_2, delete_invalid=True)
    return _read_back(spark, table).drop(BUCKET_COL)


def q_delete_invalid_groups_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """As ``delete_invalid_roundtrip``, in a table of key groups that are merged between the loads."""
    table, root = _fresh("cdlg"), scratch_path(spark, "cdlg")
    first, second, addr = _cdl_inputs(spark, sf)
    customer_data_load.load(first, addr, table, root, si.RUN_MASTER_1, rows_per_group=100)
    merge_groups(spark, table, schemas.KEYS["customer_data_load"], root, rows_per_group=500)
    customer_data_load.load(second, addr, table, root, si.RUN_MASTER_2, delete_invalid=True, rows_per_group=100)
    spark.sql(f"DROP TABLE {summary_table(table)}")
    return _read_back(spark, table).drop(GROUP_COL)


def q_merged_groups_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Two validation loads into key groups; small groups are merged after each."""
    table, root = _fresh("valm"), scratch_path(spark, "valm")
    first, second = _val_inputs(spark, sf)
    validation_stage.load(first, table, root, si.RUN_VAL_1, rows_per_group=500)
    merge_groups(spark, table, schemas.KEYS["validation_stage"], root, rows_per_group=4_000, at_once=16)
    validation_stage.load(second, table, root, si.RUN_VAL_2, rows_per_group=500)
    merge_groups(spark, table, schemas.KEYS["validation_stage"], root, rows_per_group=4_000, at_once=16)
    spark.sql(f"DROP TABLE {summary_table(table)}")
    return _read_back(spark, table).drop(GROUP_COL)


def q_schema_drift_refused(spark: SparkSession, sf: str) -> DataFrame:
    """A customer master load, then batches whose schemas changed: all are refused, the table stays as it was."""
    table, root = _fresh("cdls"), scratch_path(spark, "cdls")
    first, second, addr = _cdl_inputs(spark, sf)
    customer_data_load.load(first, addr, table, root, si.RUN_MASTER_1)
    batch, refused = customer_data_load.build(second, addr, spark.table(table), si.RUN_MASTER_2), []
    for change, rows in drifted(batch).items():
        try:
            upsert_table(rows, table, schemas.KEYS["customer_data_load"], root, check_schema=True)
        except DataCheckError:
            refused.append(change)
    return _read_back(spark, table).withColumn("REFUSED", F.lit(", ".join(refused)))


def q_file_marks_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The events beyond the newest one of the first load, from the files of a folder that hold any."""
    folder, marks = scratch_path(spark, "events"), scratch_path(spark, "marks")
    events = si.table(spark, sf, "events")
    events.repartitionByRange(16, "ts").write.parquet(folder)
    bound = watermark_bound(events.where(F.col("ts") <= F.lit(si.VAL_CUT).cast("timestamp_ntz")), "ts")
    return incremental_files(spark, folder, "ts", marks, bound=bound, schema=events.schema)


def q_checked_rebuild_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A rebuild of the employee table with its checks in the same pass; a second that fails one changes nothing."""
    table, root = _fresh("empc"), scratch_path(spark, "empc")
    employees, dept = si.emp(si.table(spark, sf, "customer")), si.dept(si.table(spark, sf, "nation"))
    emp_load.load(employees, dept, table, si.RUN_EMP, root=root, not_null=["EMPNO", "DEPTNO", "DEPT_NAME"],
                  failing={"no department location": F.length("DEPT_LOCATION") == 0})
    try:
        emp_load.load(employees, dept, table, si.RUN_STD, root=root, not_null=["COMM"])
    except DataCheckError:
        return _read_back(spark, table)
    raise AssertionError("a load with nulls in COMM was published")


def q_bucketed_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """A lookup of two tables that were written in buckets of the lookup's key: neither is shuffled."""
    orders, customers = _fresh("borders"), _fresh("bcustomers")
    write_bucketed(si.table(spark, sf, "orders"), orders, "o_custkey", 16, scratch_path(spark, "borders"))
    write_bucketed(si.table(spark, sf, "customer").where("c_custkey % 10 > 0"), customers, "c_custkey", 16, scratch_path(spark, "bcustomers"))
    found = lookup_join(spark.table(orders), spark.table(customers), [("o_custkey", "c_custkey")],
                        {"CUSTOMER_NAME": ("c_name", "UNKNOWN"), "SEGMENT": ("c_mktsegment", "NONE")}) \
        .select(F.col("o_orderkey").alias("ORDER_ID"), F.col("o_custkey").alias("CUSTOMER_ID"), "CUSTOMER_NAME", "SEGMENT")
    rows = materialize(found, "bucketed")
    for table in (orders, customers):
        spark.sql(f"DROP TABLE {table}")
    return rows


QUERIES = {
    "emp_load": q_emp_load,
    "stg_employee": q_stg_employee,
    "stg_employee_all_rows": q_stg_employee_all_rows,
    "customer_data_load": q_customer_data_load,
    "customer_load": q_customer_load,
    "validation_stage": q_validation_stage,
    "stg_employee_decimal": q_stg_employee_decimal,
    "customer_load_decimal": q_customer_load_decimal,
    "full_rebuild_roundtrip": q_full_rebuild_roundtrip,
    "first_load_roundtrip": q_first_load_roundtrip,
    "snapshot_upsert_roundtrip": q_snapshot_upsert_roundtrip,
    "bucket_upsert_roundtrip": q_bucket_upsert_roundtrip,
    "skip_unchanged_roundtrip": q_skip_unchanged_roundtrip,
    "delete_invalid_roundtrip": q_delete_invalid_roundtrip,
    "schema_drift_refused": q_schema_drift_refused,
    "file_marks_scan": q_file_marks_scan,
    "checked_rebuild_roundtrip": q_checked_rebuild_roundtrip,
    "bucketed_lookup": q_bucketed_lookup,
    "tagged_upsert_roundtrip": q_tagged_upsert_roundtrip,
    "file_pruned_upsert_roundtrip": q_file_pruned_upsert_roundtrip,
    "delete_invalid_buckets_roundtrip": q_delete_invalid_buckets_roundtrip,
    "delete_invalid_groups_roundtrip": q_delete_invalid_groups_roundtrip,
    "merged_groups_roundtrip": q_merged_groups_roundtrip,
}
