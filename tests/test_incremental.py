"""Watermark scan, change tag and keyed upsert: the two-run cases of FIXTURES.md §3."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loadsmith import schemas
from loadsmith.operators import DataCheckError, latest_per_key, lookup_join, upsert_frame
from loadsmith.operators._sizing import key_facts
from loadsmith.plans import validation_stage
from loadsmith.sources import incremental_scan
from tests.conftest import plan_text

TS = dt.datetime
RUN1, RUN2 = "2024-01-10 00:00:00", "2024-02-01 00:00:00"


def _val(vid, src, rule, ts, user="u"):
    return (vid, src, rule, 1, "OK", TS(2024, 1, 1), TS(2024, 1, 1), Decimal("1.000"), "t", 1, 1, ts, user)


@pytest.fixture(scope="module")
def two_runs(spark):
    first = spark.createDataFrame([
        _val(1, 10, 100, TS(2024, 1, 5)),
        _val(2, 10, 100, TS(2024, 1, 6)),
        _val(3, 10, 100, TS(2024, 1, 7)),
        _val(3, 10, 101, TS(2024, 1, 7)),      # two target rows share result id 3
        _val(4, 10, 100, None),                # null time: first run only
    ], schemas.DATA_SRC_VAL)
    target = validation_stage.build(first, None, RUN1)
    target_rows = target.collect()
    second = spark.createDataFrame([
        _val(1, 10, 100, TS(2024, 1, 5)),      # unchanged
        _val(2, 10, 100, TS(2024, 1, 20)),     # known key, newer: replaced
        _val(5, 10, 100, TS(2024, 1, 21)),     # new id: inserted
        _val(1, 10, 200, TS(2024, 1, 22)),     # known id, new rule: new key, tagged update
        _val(3, 10, 100, TS(2024, 1, 23)),     # id held twice by the target: one row out
        _val(6, 10, 100, TS(2024, 1, 7)),      # equal to the bound: not picked up
        _val(4, 10, 100, None),                # null time: never after the first run
    ], schemas.DATA_SRC_VAL)
    batch = validation_stage.build(second, target, RUN2, audit=True)
    result = upsert_frame(target, batch.drop("UPDATE_STRATEGY_FLAG"), ["DATA_SRC_VAL_STAGE_ID"])
    return target_rows, batch.collect(), result.collect()


def test_first_run_loads_all_with_run_time(two_runs):
    target, _, _ = two_runs
    assert len(target) == 5
    assert all(r.LOAD_TS == TS(2024, 1, 10) for r in target)


def test_second_run_batch_and_tags(two_runs):
    _, batch, _ = two_runs
    by = {(r.DATA_SRC_VAL_ID, r.VAL_RULE_ID): r for r in batch}
    assert set(by) == {(2, 100), (5, 100), (1, 200), (3, 100)}
    assert by[(5, 100)].UPDATE_STRATEGY_FLAG == 0 and by[(5, 100)].LOAD_TS == TS(2024, 2, 1)
    assert by[(2, 100)].UPDATE_STRATEGY_FLAG == 1 and by[(2, 100)].LOAD_TS == TS(2024, 1, 20)
    assert by[(1, 200)].UPDATE_STRATEGY_FLAG == 1 and by[(1, 200)].LOAD_TS == TS(2024, 1, 22)
    assert len([r for r in batch if r.DATA_SRC_VAL_ID == 3]) == 1


def test_upsert_result(two_runs):
    _, _, result = two_runs
    keys = [r.DATA_SRC_VAL_STAGE_ID for r in result]
    assert len(keys) == len(set(keys)) == 7
    row2 = [r for r in result if r.DATA_SRC_VAL_ID == 2][0]
    assert row2.LAST_UPDT_TS == TS(2024, 1, 20)


def test_empty_target_is_full_load(spark):
    src = spark.createDataFrame([_val(1, 1, 1, TS(2024, 1, 1)), _val(2, 1, 1, None)], schemas.DATA_SRC_VAL)
    empty = validation_stage.build(src, None, RUN1).where(F.lit(False))
    assert incremental_scan(src, empty, "LAST_UPDT_TS").count() == 2


def test_watermark_predicate_reaches_scan(spark, scratch):
    path = f"{scratch}/src"
    spark.createDataFrame([_val(i, 1, 1, TS(2024, 1, 1 + i)) for i in range(5)],
                          schemas.DATA_SRC_VAL).write.parquet(path)
    src = spark.read.parquet(path)
    target = src.where(F.col("LAST_UPDT_TS") <= TS(2024, 1, 3))
    out = incremental_scan(src, target, "LAST_UPDT_TS")
    assert out.count() == 2
    assert "GreaterThan(LAST_UPDT_TS" in plan_text(out)


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k long, v string")
    batch = spark.createDataFrame([(2, "B"), (3, "c")], "k long, v string")
    once = upsert_frame(target, batch, "k")
    twice = upsert_frame(once, batch, "k")
    assert sorted(once.collect(), key=str) == sorted(twice.collect(), key=str)
    assert sorted((r.k, r.v) for r in once.collect() if r.k is not None) == [(1, "a"), (2, "B"), (3, "c")]


def test_null_batch_keys_append(spark):
    target = spark.createDataFrame([(1, "a")], "k long, v string")
    batch = spark.createDataFrame([(None, "x")], "k long, v string")
    once = upsert_frame(target, batch, "k")
    assert upsert_frame(once, batch, "k").count() == 3


def test_duplicate_batch_key_fails(spark):
    target = spark.createDataFrame([(1, "a")], "k long, v string")
    batch = spark.createDataFrame([(2, "x"), (2, "y")], "k long, v string")
    with pytest.raises(Exception, match="batch keys must be unique: key \\(2\\) occurs 2 times"):
        upsert_frame(target, batch, "k").collect()
    with pytest.raises(DataCheckError):                     # at once, with the batch's statistics
        upsert_frame(target, batch, "k", facts=key_facts(batch, "k"))


def test_schema_drift_fails(spark):
    target = spark.createDataFrame([(1, "a")], "k long, v string")
    batch = spark.createDataFrame([(2, 5)], "k long, v int")
    with pytest.raises(DataCheckError):
        upsert_frame(target, batch, "k", check_schema=True)


def test_lookup_keeps_left_rows_and_rejects_duplicates(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    lk = spark.createDataFrame([(1, "one"), (3, "three")], "k long, name string")
    out = lookup_join(left, lk, "k", {"NAME": ("name", "NONE")})
    assert out.count() == 3
    assert sorted(r.NAME for r in out.collect()) == ["NONE", "NONE", "one"]
    dup = spark.createDataFrame([(1, "one"), (1, "uno")], "k long, name string")
    with pytest.raises(Exception, match="lookup keys must be unique: key \\(1\\)"):
        lookup_join(left, dup, "k", {"NAME": ("name", "NONE")}).collect()
    assert lookup_join(left, dup, "k", {"NAME": ("name", "NONE")}, on_duplicate="fanout").count() == 4


@pytest.mark.parametrize("rows", [10, 50_000])
def test_duplicate_rule_is_the_same_at_every_size(spark, scratch, rows):
    """Only keys that a left row meets count, in a small lookup as in a large stored one."""
    lk = spark.range(rows).selectExpr("id AS k", "concat('v', id) AS v").union(
        spark.createDataFrame([(rows - 1, "dup")], "k long, v string"))
    lk.write.parquet(f"{scratch}/lk")
    lk = spark.read.parquet(f"{scratch}/lk")
    unused = spark.createDataFrame([(1,), (2,), (-5,)], "k long")
    assert sorted((r.k, r.V) for r in lookup_join(unused, lk, "k", {"V": ("v", "NONE")}).collect()) == \
        [(-5, "NONE"), (1, "v1"), (2, "v2")]
    with pytest.raises(Exception, match="must be unique"):
        lookup_join(spark.createDataFrame([(rows - 1,)], "k long"), lk, "k", {"V": ("v", "NONE")}).collect()


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_null_keys_match_nothing_in_the_joins(spark, threshold):
    """Same results with and without broadcast; left columns of any type."""
    from loadsmith.operators import existence_flag

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        left = spark.createDataFrame([(i, None if i % 3 == 0 else i % 7) for i in range(300)], "row long, k long") \
            .withColumn("nested", F.struct(F.create_map(F.lit("a"), F.col("row"))))
        lk = spark.createDataFrame([(k, f"n{k}") for k in range(5)] + [(None, "null")], "k long, name string")
        out = lookup_join(left, lk, "k", {"NAME": ("name", "NONE")})
        expected = {r.row: f"n{r.k}" if r.k is not None and r.k < 5 else "NONE" for r in left.collect()}
        assert {r.row: r.NAME for r in out.collect()} == expected and out.count() == 300
        flags = existence_flag(left, "k", lk, "k", name="F")
        assert {r.row: r.F for r in flags.collect()} == {k: "N" if v == "NONE" else "Y" for k, v in expected.items()}
        target = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c"), (2, "d")], "k long, v string")
        batch = spark.createDataFrame([(2, "D"), (3, "e")], "k long, v string")
        for facts in (None, key_facts(batch, "k")):
            got = upsert_frame(target, batch, "k", facts=facts)
            assert sorted(map(str, map(tuple, got.collect()))) == \
                sorted(map(str, [(None, "a"), (None, "b"), (1, "c"), (2, "D"), (3, "e")]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_key_facts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("bcd", 2), (None, 3), ("x", None)], "s string, n int")
    facts = key_facts(df, ["s", "n"])
    assert (facts.rows, facts.null_rows, facts.keys, facts.top) == (5, 2, 2, 2)
    assert facts.bytes == (1 + 16 + 64) + (3 + 16 + 64) and facts.fits() and not facts.fits(100)
    empty = key_facts(df.where("false"), "s")
    assert (empty.rows, empty.keys, empty.top, empty.bytes) == (0, 0, 0, 0)


def test_latest_per_key_keeps_every_row_it_should(spark):
    ts = TS
    rows = [(1, None, "only"), (2, None, "old"), (2, ts(2024, 1, 1), "new"), (None, ts(2024, 1, 1), "n1"), (None, None, "n2"),
            (3, ts(2024, 1, 2), "b"), (3, ts(2024, 1, 2), "a")]
    df = spark.createDataFrame(rows, "k long, t timestamp_ntz, v string")
    got = sorted(((r.k, r.v) for r in latest_per_key(df, "k", "t").collect()), key=str)
    assert got == sorted([(1, "only"), (2, "new"), (None, "n1"), (None, "n2"), (3, "a")], key=str)
    text = plan_text(latest_per_key(df, "k", "t"))
    assert "SortAggregate" not in text and "WindowGroupLimit" in text


def test_partitioned_source_prunes_partitions(spark, scratch):
    path = f"{scratch}/by_day"
    rows = [_val(i, 1, 1, TS(2024, 1, 1 + i, 12)) for i in range(6)]
    (spark.createDataFrame(rows, schemas.DATA_SRC_VAL)
     .withColumn("LOAD_DAY", F.to_date("LAST_UPDT_TS")).write.partitionBy("LOAD_DAY").parquet(path))
    src = spark.read.parquet(path)
    out = incremental_scan(src, src, "LAST_UPDT_TS", bound="2024-01-04 12:00:00", partition_col="LOAD_DAY")
    assert sorted(r.DATA_SRC_VAL_ID for r in out.collect()) == [4, 5]
    text = plan_text(out)
    assert "PartitionFilters: [isnotnull(LOAD_DAY" in text and "2024-01-04" in text


def test_plan_build_with_partitioned_source(spark, scratch):
    path = f"{scratch}/val_by_day"
    rows = [_val(i, 1, 1, TS(2024, 1, 1 + i, 12)) for i in range(6)]
    (spark.createDataFrame(rows, schemas.DATA_SRC_VAL)
     .withColumn("LOAD_DAY", F.to_date("LAST_UPDT_TS")).write.partitionBy("LOAD_DAY").parquet(path))
    src = spark.read.parquet(path)
    target = validation_stage.build(src.where("LOAD_DAY <= '2024-01-04'"), None, RUN1)
    batch = validation_stage.build(src, target, RUN2, partition_col="LOAD_DAY")
    assert sorted(r.DATA_SRC_VAL_ID for r in batch.collect()) == [4, 5]
    assert "LOAD_DAY" not in batch.columns
