"""Watermark scan that opens only files with new rows."""

import os

import pytest
from pyspark.sql import functions as F

from loadsmith.plans import standins as si
from loadsmith.plans import validation_stage
from loadsmith.registry import plan_queries as pq
from loadsmith.sources import MissingInputError
from loadsmith.sources.file_marks import add_marks, incremental_files, known_marks

SF = "/root/testdata/sf0.001"


def put(spark, folder, *rows):
    spark.createDataFrame(list(rows), "k long, wm long").coalesce(1).write.mode("append").parquet(folder)


def opened(df):
    return len(df.inputFiles())


def keys(df):
    return sorted(r.k for r in df.collect())


def test_only_files_with_new_rows_are_opened(spark, scratch):
    folder, marks = f"{scratch}/with space", f"{scratch}/marks"
    for i in range(5):
        put(spark, folder, (2 * i, 10 * i), (2 * i + 1, 10 * i + 1))
    assert keys(incremental_files(spark, folder, "wm", marks, bound=None)) == list(range(10))
    schema = spark.read.parquet(folder).schema
    assert add_marks(spark, folder, marks, "wm", schema) == []                    # every file was read once
    some = incremental_files(spark, folder, "wm", marks, bound="30")
    assert keys(some) == [7, 8, 9] and opened(some) == 2
    assert opened(incremental_files(spark, folder, "wm", marks, bound="31")) == 1        # strict
    none = incremental_files(spark, folder, "wm", marks, bound="41")
    assert none.columns == ["k", "wm"] and none.count() == 0 and opened(none) == 0
    # Late rows in a new file; nulls are beyond nothing; a file without rows is opened once.
    put(spark, folder, (100, 35), (101, None))
    put(spark, folder, (102, None))
    put(spark, folder, *[])
    assert len(add_marks(spark, folder, marks, "wm", schema)) == 3
    assert add_marks(spark, folder, marks, "wm", schema) == []
    some = incremental_files(spark, folder, "wm", marks, bound="30")
    assert keys(some) == [7, 8, 9, 100] and opened(some) == 3


def test_files_that_change_or_go(spark, scratch):
    folder, marks = f"{scratch}/f", f"{scratch}/marks"
    put(spark, folder, (1, 1))
    put(spark, folder, (2, 2))
    schema = spark.read.parquet(folder).schema
    add_marks(spark, folder, marks, "wm", schema)
    files = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))
    gone, changed = files
    if spark.read.parquet(f"{folder}/{gone}").first().k == 2:
        gone, changed = changed, gone
    os.remove(f"{folder}/{gone}")
    put(spark, f"{scratch}/other", (2, 50))
    new = next(f for f in os.listdir(f"{scratch}/other") if f.endswith(".parquet"))
    for crc in (f"{folder}/.{changed}.crc",):
        os.remove(crc)
    os.replace(f"{scratch}/other/{new}", f"{folder}/{changed}")                    # written again in place
    os.utime(f"{folder}/{changed}", (2_000_000_000, 2_000_000_000))
    assert keys(incremental_files(spark, folder, "wm", marks, bound="10")) == [2]
    assert keys(incremental_files(spark, folder, "wm", marks, bound="0")) == [2]
    # Marks that a run which died added twice count once.
    known_marks(spark, marks, schema["wm"].dataType).write.parquet(f"{marks}/again")
    assert known_marks(spark, marks, schema["wm"].dataType).count() == 3
    with pytest.raises(MissingInputError):
        incremental_files(spark, folder, "no", marks, bound="0")


def test_a_load_by_file_marks_equals_one_without(spark, scratch):
    first, second = pq._val_inputs(spark, SF)
    folder, marks = f"{scratch}/src", f"{scratch}/marks"
    first.write.parquet(folder)
    for kind, options in (("m", {"file_marks": marks}), ("p", {})):
        validation_stage.load(folder, f"t_marks_{kind}", f"{scratch}/{kind}", si.RUN_VAL_1, spark=spark, **options)
    bound = first.agg(F.max("LAST_UPDT_TS")).first()[0]
    second.where(F.col("LAST_UPDT_TS") > F.lit(bound)).write.mode("append").parquet(folder)
    for kind, options in (("m", {"file_marks": marks}), ("p", {})):
        validation_stage.load(folder, f"t_marks_{kind}", f"{scratch}/{kind}", si.RUN_VAL_2, spark=spark, **options)
    rows = [sorted(map(str, spark.table(f"t_marks_{kind}").collect())) for kind in "mp"]
    assert rows[0] == rows[1] and len(rows[0]) > first.count()
    with pytest.raises(ValueError, match="source path"):
        validation_stage.load(first, "t_marks_m", f"{scratch}/m", si.RUN_VAL_2, file_marks=marks)
