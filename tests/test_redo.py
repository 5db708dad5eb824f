"""Bucket and group tables: one commit for all partitions and the watermark, whenever a run dies."""

import os

import pytest

from loadsmith.scratch import create_file, read_file
from loadsmith.sources import key_groups as kg
from loadsmith.sources import redo, sinks
from loadsmith.sources.sinks import ConcurrentWriteError, stored_watermark, upsert_table_buckets

SCHEMA = "k long, v string, wm long"
FIRST = [(i, f"v{i}", 1) for i in range(40)] + [(None, "loose", 1)]
SECOND = [(3, "new", 2), (17, "new", 2), (90, "added", 2), (None, "loose 2", 2)]
WANT = {**{i: (i, f"v{i}", 1) for i in range(40)}, **{r[0]: r for r in SECOND if r[0] is not None}}
AFTER = sorted([*WANT.values(), (None, "loose", 1), (None, "loose 2", 2)], key=str)


class Dead(BaseException):
    pass


def die(*a, **k):
    raise Dead


def writer(kind):
    def buckets(df, table, path, **options):
        upsert_table_buckets(df, table, "k", path, buckets=4, watermark="wm", **options)

    def groups(df, table, path, **options):
        kg.upsert_table_groups(df, table, "k", path, rows_per_group=10, watermark="wm", **options)

    return buckets if kind == "buckets" else groups


def rows_of(spark, table):
    return sorted((tuple(r) for r in spark.table(table).select("k", "v", "wm").collect()), key=str)


def nothing_left(spark, path):
    return read_file(spark, redo.record_path(path)) is None and \
        [f for f in os.listdir(f"{path}-redo") if not f.startswith(".")] == []


@pytest.mark.parametrize("kind", ["buckets", "groups"])
@pytest.mark.parametrize("at", ["before the record", "before the overwrite", "after some partitions", "before the marks", "before the record goes"])
def test_a_run_that_dies_ends_in_one_state(spark, scratch, monkeypatch, kind, at):
    table, path, write = f"t_redo_{kind}_{at.replace(' ', '_')}", f"{scratch}/t", writer(kind)
    write(spark.createDataFrame(FIRST, SCHEMA), table, path)
    before, real = rows_of(spark, table), redo.overwrite_partitions

    def some(rows, name):       # as a driver that dies while it puts folders in place
        part = kg.GROUP_COL if kind == "groups" else sinks.BUCKET_COL
        first = rows.agg({part: "min"}).first()[0]
        real(rows.where(rows[part] == first), name)
        raise Dead

    with monkeypatch.context() as m:
        if at == "before the record":
            m.setattr(redo, "create_file", die)
        elif at == "before the overwrite":
            m.setattr(redo, "overwrite_partitions", die)
        elif at == "after some partitions":
            m.setattr(redo, "overwrite_partitions", some)
        elif at == "before the marks":
            m.setattr(sinks, "record_watermark", die)
        else:
            m.setattr(redo, "remove", die)
        with pytest.raises(Dead):
            write(spark.createDataFrame(SECOND, SCHEMA), table, path)
    spark.catalog.refreshTable(table)
    if at in ("before the record", "before the overwrite"):
        assert rows_of(spark, table) == before
    redo.finish_replace(spark, table, path)
    if at == "before the record":
        assert rows_of(spark, table) == before and stored_watermark(spark, table, "wm") == "1"
        write(spark.createDataFrame(SECOND, SCHEMA), table, path)
    else:
        assert nothing_left(spark, path)
    assert rows_of(spark, table) == AFTER and stored_watermark(spark, table, "wm") == "2"
    # The next load is as if nothing had happened.
    write(spark.createDataFrame([(3, "newer", 3)], SCHEMA), table, path)
    assert rows_of(spark, table) == sorted([r if r[0] != 3 else (3, "newer", 3) for r in AFTER], key=str)


@pytest.mark.parametrize("kind", ["buckets", "groups"])
def test_the_second_of_two_writers_fails(spark, scratch, kind):
    table, path, write = f"t_redo_two_{kind}", f"{scratch}/t", writer(kind)
    write(spark.createDataFrame(FIRST, SCHEMA), table, path)

    def other_first(batch):
        write(spark.createDataFrame(SECOND, SCHEMA), table, path)

    with pytest.raises(ConcurrentWriteError):
        write(spark.createDataFrame([(3, "mine", 9), (None, "mine", 9)], SCHEMA), table, path, check=other_first)
    assert rows_of(spark, table) == AFTER and stored_watermark(spark, table, "wm") == "2" and nothing_left(spark, path)

    def at_its_commit(batch):
        create_file(spark, redo.record_path(path), "cut off")

    with pytest.raises(ConcurrentWriteError):
        write(spark.createDataFrame([(3, "mine", 9)], SCHEMA), table, path, check=at_its_commit)
    assert rows_of(spark, table) == AFTER
    write(spark.createDataFrame([(3, "mine", 9)], SCHEMA), table, path)      # a cut-off record goes
    assert (3, "mine", 9) in rows_of(spark, table)


def test_loose_rows_get_buckets_of_bounded_rows(spark, scratch, monkeypatch):
    monkeypatch.setattr(sinks, "LOOSE_ROWS", 50)
    none = spark.range(200).selectExpr("CAST(NULL AS LONG) AS k", "id AS v")
    for _ in range(2):
        upsert_table_buckets(none, "t_loose", "k", f"{scratch}/t", buckets=2)
    sizes = [r[1] for r in spark.table("t_loose").groupBy(sinks.BUCKET_COL).count().collect()]
    assert sum(sizes) == 400 and len(sizes) == 6
