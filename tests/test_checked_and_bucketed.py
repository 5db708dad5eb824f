"""Checks made by the write itself; lookups of bucketed tables without a shuffle."""

import os

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from loadsmith.operators import DataCheckError, lookup_join
from loadsmith.plans import emp_load
from loadsmith.plans import standins as si
from loadsmith.sources.sinks import table_location, write_bucketed, write_checked

SF = "/root/testdata/sf0.001"


def test_a_failing_row_is_never_published(spark, scratch):
    def df(*rows):
        return spark.createDataFrame(list(rows), "k long, v long")

    root = f"{scratch}/c"
    with pytest.raises(DataCheckError, match="null in k"):
        write_checked(df((1, 1), (None, 2)), "t_chk", root, not_null=["k"])
    assert not spark.catalog.tableExists("t_chk") and os.listdir(root) == []
    write_checked(df((1, 1), (2, None)), "t_chk", root, not_null="k", failing={"v below 0": F.col("v") < 0})
    at = table_location(spark, "t_chk")
    for rows, checks in (([(1, -1), (2, -2)], {"failing": {"v below 0": F.col("v") < 0}}), ([(None, 1)], {"not_null": ["v", "k"]})):
        with pytest.raises(DataCheckError):
            write_checked(df(*rows), "t_chk", root, **checks)
    with pytest.raises(DataCheckError, match="'v below 0': 2"):
        write_checked(df((1, -1), (2, -2)), "t_chk", root, failing={"v below 0": F.col("v") < 0})
    with pytest.raises(DataCheckError, match="schema"):
        write_checked(df((1, 1)).withColumn("w", F.lit(1)), "t_chk", root)
    assert table_location(spark, "t_chk") == at and sorted(map(tuple, spark.table("t_chk").collect()), key=str) == [(1, 1), (2, None)]
    write_checked(df().limit(0), "t_chk", root, not_null=["k", "v"])
    assert spark.table("t_chk").count() == 0


def test_checks_read_the_source_once(spark, scratch):
    """The rows are computed once: an accumulator in their only pass counts each of them once."""
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for batch in rows:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(1000).mapInArrow(count, "id long")
    write_checked(rows, "t_once", f"{scratch}/o", not_null=["id"], failing={"below 0": F.col("id") < 0})
    assert seen.value == 1000 and spark.table("t_once").count() == 1000


def test_rebuild_with_checks(spark, scratch):
    emp, dept = si.emp(si.table(spark, SF, "customer")), si.dept(si.table(spark, SF, "nation"))
    emp_load.load(emp, dept, "t_emp_chk", si.RUN_EMP, root=f"{scratch}/e", not_null=["DEPTNO"])
    assert spark.table("t_emp_chk").count() == emp_load.build(emp, dept, si.RUN_EMP).count()
    with pytest.raises(ValueError, match="root"):
        emp_load.load(emp, dept, "t_emp_chk2", si.RUN_EMP, not_null=["DEPTNO"])


def test_bucketed_lookup_has_no_exchange(spark, scratch):
    left = spark.range(2000).selectExpr("if(id % 9 = 0, null, id % 300) as k", "id as v")
    right = spark.range(250).selectExpr("id as k", "concat('n', id) as name")
    write_bucketed(left, "t_bleft", "k", 8, f"{scratch}/l")
    write_bucketed(right, "t_bright", "k", 8, f"{scratch}/r")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookup_join(spark.table("t_bleft"), spark.table("t_bright"), "k", {"name": ("name", "none")})
        text = plan_text(out)
        assert "Exchange" not in text and "SortMergeJoin" in text
        assert sorted(map(tuple, out.collect()), key=str) == sorted(
            map(tuple, lookup_join(left, right, "k", {"name": ("name", "none")}).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    files = [f for f in os.listdir(f"{scratch}/l") if f.endswith(".parquet")]
    assert len(files) == 8
    write_bucketed(right.where("k < 5"), "t_bright", "k", 8, f"{scratch}/r")        # a rebuild replaces it
    assert spark.table("t_bright").count() == 5
