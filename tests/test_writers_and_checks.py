"""Writers (full rebuild, versioned upsert, bucket upsert) and data checks."""

import datetime as dt

import pytest

from loadsmith.operators import (
    DataCheckError, assert_not_null, assert_relationships, assert_unique, relationship_violations,
    unique_violations,
)
from loadsmith.sources import (
    MissingInputError, read_source, typed_source, upsert_table, upsert_table_buckets, write_full,
)


def test_full_rebuild(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    write_full(df, "t_full")
    write_full(df.limit(1), "t_full")
    assert spark.table("t_full").count() == 1


def test_versioned_upsert_two_runs(spark, scratch):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    p1 = upsert_table(first, "t_ups", "k", f"{scratch}/t_ups", run_id="1")
    second = spark.createDataFrame([(2, "B"), (3, "c")], "k long, v string")
    p2 = upsert_table(second, "t_ups", "k", f"{scratch}/t_ups", run_id="2", check_schema=True)
    assert p1 != p2
    assert sorted(tuple(r) for r in spark.table("t_ups").collect()) == [(1, "a"), (2, "B"), (3, "c")]
    # the previous version is left intact
    assert spark.read.parquet(p1).count() == 2


def test_bucket_upsert_rewrites_touched_buckets(spark, scratch):
    first = spark.createDataFrame([(i, f"v{i}") for i in range(100)], "k long, v string")
    upsert_table_buckets(first, "t_bkt", "k", f"{scratch}/t_bkt", buckets=8)
    second = spark.createDataFrame([(5, "new5"), (200, "v200")], "k long, v string")
    upsert_table_buckets(second, "t_bkt", "k", f"{scratch}/t_bkt", buckets=8)
    spark.catalog.refreshTable("t_bkt")
    rows = {r.k: r.v for r in spark.table("t_bkt").collect()}
    assert len(rows) == 101 and rows[5] == "new5" and rows[200] == "v200" and rows[6] == "v6"


def test_missing_input_is_clear(spark):
    with pytest.raises(MissingInputError):
        read_source(spark, "no_such_db.no_such_table")
    df = spark.createDataFrame([(1,)], "a long")
    with pytest.raises(MissingInputError, match="b"):
        typed_source(df, ["a", "b"])


def test_checks(spark):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None), (3, 10)], "id long, fk long")
    parent = spark.createDataFrame([(10,)], "pk long")
    assert [r.id for r in relationship_violations(child, "fk", parent, "pk").collect()] == [2]
    assert [tuple(r) for r in unique_violations(child, "id").collect()] == [(3, 2)]
    with pytest.raises(DataCheckError):
        assert_not_null(child, "fk")
    with pytest.raises(DataCheckError):
        assert_unique(child, "id")
    with pytest.raises(DataCheckError):
        assert_relationships(child, "fk", parent, "pk")
    assert_unique(child.where("id < 3"), "id")


def test_plan_load_two_runs_records_watermark(spark, scratch):
    """validation_stage.load twice on catalog tables; the second run uses the stored mark."""
    import datetime as dt
    from decimal import Decimal

    from loadsmith import schemas
    from loadsmith.plans import validation_stage
    from loadsmith.sources.sinks import stored_watermark

    def row(vid, ts):
        return (vid, 1, 1, 1, "OK", ts, ts, Decimal("1.000"), "t", 1, 1, ts, "u")

    ts = dt.datetime
    run1 = spark.createDataFrame([row(1, ts(2024, 1, 1)), row(2, ts(2024, 1, 2))], schemas.DATA_SRC_VAL)
    validation_stage.load(run1, "t_val", f"{scratch}/t_val", as_of="2024-01-03 00:00:00")
    assert stored_watermark(spark, "t_val", "LAST_UPDT_TS") == "2024-01-02 00:00:00"
    run2 = spark.createDataFrame([row(1, ts(2024, 1, 1)), row(2, ts(2024, 1, 5)), row(3, ts(2024, 1, 4))],
                                 schemas.DATA_SRC_VAL)
    validation_stage.load(run2, "t_val", f"{scratch}/t_val", as_of="2024-01-06 00:00:00")
    out = {r.DATA_SRC_VAL_ID: r for r in spark.table("t_val").collect()}
    assert len(out) == 3
    assert out[2].LOAD_TS == ts(2024, 1, 5) and out[3].LOAD_TS == ts(2024, 1, 6)
    assert out[1].LOAD_TS == ts(2024, 1, 3)
    assert stored_watermark(spark, "t_val", "LAST_UPDT_TS") == "2024-01-05 00:00:00"


def test_merge_is_refused_for_parquet_and_auto_falls_back(spark, scratch):
    from loadsmith.sources.sinks import merge_into, table_provider

    first = spark.createDataFrame([(1, "a")], "k long, v string")
    upsert_table(first, "t_auto", "k", f"{scratch}/t_auto", run_id="1")
    assert table_provider(spark, "t_auto") == "parquet"
    with pytest.raises(ValueError, match="MERGE"):
        merge_into(first, "t_auto", "k")
    upsert_table(spark.createDataFrame([(1, "b")], "k long, v string"), "t_auto", "k",
                 f"{scratch}/t_auto", run_id="2", method="auto")
    assert [tuple(r) for r in spark.table("t_auto").collect()] == [(1, "b")]


def test_full_rebuild_versioned_and_null_key_warning(spark, scratch):
    from loadsmith.plans import standins as si
    from loadsmith.plans import stg_employee

    emp = si.employees(si.table(spark, "/root/testdata/sf0.001", "orders"))
    stg_employee.load(emp, "t_stg", si.RUN_STD, root=f"{scratch}/t_stg")
    stg_employee.load(emp, "t_stg", si.RUN_STD, root=f"{scratch}/t_stg")
    assert spark.table("t_stg").count() == stg_employee.build(emp, si.RUN_STD).count()
    with pytest.warns(UserWarning, match="null key"):
        upsert_table(spark.createDataFrame([(None, "x")], "k long, v string"), "t_nullk", "k",
                     f"{scratch}/t_nullk")


def test_bucket_upsert_null_keys_append(spark, scratch):
    first = spark.createDataFrame([(None, "n1"), (None, "n2"), (1, "a")], "k long, v string")
    upsert_table_buckets(first, "t_bnull", "k", f"{scratch}/t_bnull", buckets=4)
    second = spark.createDataFrame([(None, "n3"), (1, "A")], "k long, v string")
    upsert_table_buckets(second, "t_bnull", "k", f"{scratch}/t_bnull", buckets=4)
    spark.catalog.refreshTable("t_bnull")
    rows = sorted((r.k if r.k is not None else -1, r.v) for r in spark.table("t_bnull").collect())
    assert rows == [(-1, "n1"), (-1, "n2"), (-1, "n3"), (1, "A")]


def test_bucket_count_is_stored_and_checked(spark, scratch):
    first = spark.createDataFrame([(i, f"v{i}") for i in range(50)], "k long, v string")
    with pytest.raises(ValueError, match="number of key buckets"):
        upsert_table_buckets(first, "t_nb", "k", f"{scratch}/t_nb")
    upsert_table_buckets(first, "t_nb", "k", f"{scratch}/t_nb", buckets=8)
    with pytest.raises(ValueError, match="stored in 8"):
        upsert_table_buckets(first, "t_nb", "k", f"{scratch}/t_nb", buckets=16)
    upsert_table_buckets(first, "t_nb", "k", f"{scratch}/t_nb")
    assert spark.table("t_nb").count() == 50


def test_first_bucket_load_checks_keys(spark, scratch):
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    with pytest.raises(DataCheckError):
        upsert_table_buckets(twice, "t_b1", "k", f"{scratch}/t_b1", buckets=4)
    assert not spark.catalog.tableExists("t_b1")


def test_null_keys_are_spread_and_never_rewritten(spark, scratch):
    import os

    first = spark.range(200).selectExpr("CAST(NULL AS LONG) AS k", "id AS v")
    upsert_table_buckets(first, "t_bn", "k", f"{scratch}/t_bn", buckets=8)
    parts = {r[0] for r in spark.table("t_bn").select("_key_bucket").distinct().collect()}
    assert len(parts) > 3 and max(parts) < 0
    old = {f for d, _, names in os.walk(f"{scratch}/t_bn") for f in names if f.endswith(".parquet")}
    upsert_table_buckets(spark.createDataFrame([(None, 1), (5, 2)], "k long, v long"), "t_bn", "k", f"{scratch}/t_bn")
    new = {f for d, _, names in os.walk(f"{scratch}/t_bn") for f in names if f.endswith(".parquet")}
    assert old <= new and spark.table("t_bn").count() == 202


@pytest.mark.parametrize("buckets", [None, 4])
def test_a_batch_that_does_not_fit_is_never_published(spark, scratch, buckets):
    """Target int, batch bigint: values that fit are cast, others fail; the table stays readable."""
    name = f"t_fit{buckets}"

    def write(rows):
        if buckets:
            upsert_table_buckets(rows, name, "k", f"{scratch}/{name}", buckets=buckets)
        else:
            upsert_table(rows, name, "k", f"{scratch}/{name}")

    write(spark.createDataFrame([(1, 1)], "k long, v int"))
    write(spark.createDataFrame([(2, 2)], "k long, v long"))
    assert sorted((r.k, r.v) for r in spark.table(name).collect()) == [(1, 1), (2, 2)]
    with pytest.raises(Exception, match="v does not fit int"):
        write(spark.createDataFrame([(3, 2 ** 40)], "k long, v long"))
    with pytest.raises(DataCheckError, match="schema change"):
        write(spark.createDataFrame([(3, 3, 3)], "k long, v int, w int"))
    assert dict(spark.table(name).dtypes)["v"] == "int" and spark.table(name).count() == 2


def test_rebuild_replaces_the_schema(spark, scratch):
    write_full(spark.createDataFrame([(1, "a")], "k long, v string"), "t_reb", f"{scratch}/t_reb")
    write_full(spark.createDataFrame([(1, "a", 2.0)], "k long, v string, w double"), "t_reb", f"{scratch}/t_reb")
    assert spark.table("t_reb").columns == ["k", "v", "w"] and spark.table("t_reb").first().w == 2.0


def test_sources_are_checked_and_cast(spark):
    from loadsmith import schemas

    text = spark.createDataFrame([("10", "Sales", "X")], "DEPTNO string, DNAME string, LOC string")
    assert typed_source(text, schemas.DEPT).schema == schemas.DEPT and typed_source(text, schemas.DEPT).first().DEPTNO == 10
    bad = spark.createDataFrame([("ten", "Sales", "X")], "DEPTNO string, DNAME string, LOC string")
    with pytest.raises(Exception, match="DEPTNO does not fit bigint"):
        typed_source(bad, schemas.DEPT).collect()
    path = spark.createDataFrame([(10.5, "a", "b")], "DEPTNO double, DNAME string, LOC string")
    with pytest.raises(Exception, match="DEPTNO does not fit bigint"):
        typed_source(path, schemas.DEPT).collect()
