"""The streaming keyed load keeps the newest version of every key, whatever comes when."""

import datetime as dt
from decimal import Decimal

from loadsmith import schemas
from loadsmith.plans import standins as si
from loadsmith.plans import validation_stage
from loadsmith.streaming import stream_validation_stage

SF = "/root/testdata/sf0.001"
AS_OF = "2024-02-01 00:00:00"
TS = dt.datetime


def _val(vid, t, user="u"):
    return (vid, 1, 1, 1, "OK", TS(2024, 1, 1), TS(2024, 1, 1), Decimal("1.000"), "t", 1, 1, t, user)


def _deliver(spark, scratch, table, number, rows):
    spark.createDataFrame(rows, schemas.DATA_SRC_VAL).coalesce(1).write.parquet(f"{scratch}/in/part={number}")
    query = stream_validation_stage(spark, f"{scratch}/in/*", table, f"{scratch}/t", as_of=AS_OF,
                                    checkpoint=f"{scratch}/ckpt")
    assert query.exception() is None
    return {r.DATA_SRC_VAL_ID: (r.LAST_UPDT_TS, r.LAST_UPDT_USER_ID) for r in spark.table(table).collect()}


def test_late_rows_null_times_and_duplicates_are_not_lost(spark, scratch):
    day = lambda d: TS(2024, 1, d)
    first = _deliver(spark, scratch, "t_stream", 1, [_val(1, day(10))])
    assert first == {1: (day(10), "u")}
    second = _deliver(spark, scratch, "t_stream", 2, [_val(2, day(5)), _val(3, day(12)), _val(4, None), _val(1, day(3), "stale")])
    assert second == {1: (day(10), "u"), 2: (day(5), "u"), 3: (day(12), "u"), 4: (None, "u")}
    # two versions of a key in one delivery, and a first time for a row that had none
    third = _deliver(spark, scratch, "t_stream", 3, [_val(2, day(6), "a"), _val(2, day(7), "b"), _val(4, day(1), "c")])
    assert third == {1: (day(10), "u"), 2: (day(7), "b"), 3: (day(12), "u"), 4: (day(1), "c")}
    # a restart with nothing new changes nothing
    query = stream_validation_stage(spark, f"{scratch}/in/*", "t_stream", f"{scratch}/t", as_of=AS_OF, checkpoint=f"{scratch}/ckpt")
    assert query.exception() is None and spark.table("t_stream").count() == 4


def test_stream_ends_in_the_newest_rows_of_all_deliveries(spark, scratch):
    events = si.table(spark, SF, "events")
    one = si.data_src_val(events).where("VAL_EXEC_START_TS <= '2024-01-15'")
    two = si.data_src_val(events, modified_before=si.VAL_CUT)
    for i, rows in enumerate((one, two)):
        rows.write.parquet(f"{scratch}/in/part={i}")
        stream_validation_stage(spark, f"{scratch}/in/*", "t_stream2", f"{scratch}/t", as_of=AS_OF,
                                checkpoint=f"{scratch}/ckpt", source_schema=rows.schema)
    from loadsmith.operators import latest_per_key

    both = validation_stage.build(one.unionByName(two), None, AS_OF)
    want = latest_per_key(both, [validation_stage.KEY], "LAST_UPDT_TS").select(validation_stage.KEY, "LAST_UPDT_TS")
    got = spark.table("t_stream2").select(validation_stage.KEY, "LAST_UPDT_TS")
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
