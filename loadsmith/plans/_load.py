"""What the three incremental loads share: scan, build, check, publish."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from loadsmith import schemas
from loadsmith.operators.checks import assert_relationships
from loadsmith.operators._sizing import key_facts
from loadsmith.operators.upsert import changed_rows, latest_per_key
from loadsmith.scratch import Scratch
from loadsmith.sources.file_marks import incremental_files
from loadsmith.sources.key_groups import GROUP_COL, upsert_table_groups
from loadsmith.sources.redo import finish_replace
from loadsmith.sources.sinks import (
    BUCKET_COL, finish_publish, stored_watermark, table_exists, upsert_table, upsert_table_buckets,
)
from loadsmith.sources.tagged import upsert_tagged
from loadsmith.sources.tables import as_source, incremental_scan, typed_source, watermark_bound


def new_rows(source: DataFrame, schema: T.StructType, target: DataFrame | None, wm: str | None, *, bound=None,
             partition_col: str | None = None, lookback: str | None = None, cast: bool = True) -> DataFrame:
    """The declared columns of the source's rows beyond the watermark; all of them with ``wm=None``.

    The filter stands on the raw columns, so it reaches the file scan."""
    if wm is not None:
        source = incremental_scan(source, target, wm, bound=bound, partition_col=partition_col, lookback=lookback,
                                  lazy=True)
    return typed_source(source, schema, cast=cast)


def run_load(spark: SparkSession, source: DataFrame | str, schema: T.StructType, plan: str, keys,
             build: Callable[[DataFrame, DataFrame | None], DataFrame], table: str, root: str, *,
             buckets: int | None = None, rows_per_group: int | None = None, dedupe: bool = False, partition_col: str | None = None,
             lookback: str | None = None, require_keys: bool = False, references=(), check_schema: bool = False, tag=None,
             skip_unchanged: str | None = None, invalid=None, file_marks: str | None = None):
    """Scan the rows beyond the table's watermark, build the batch and upsert it.

    The scanned rows are stored once, so lookups and tags see their true size.
    ``references``: (column, parent frame, parent column); a row of the new ones whose
    non-null column has no parent fails the load before anything is published.
    ``rows_per_group`` makes a table of key groups, of which only those are rewritten that
    hold a key of the batch; an existing one is known by its columns.  ``tag``: (id column, rows
    before the tag, rows from them and the tag); a table of versions is then read once for tag
    and upsert (``sources.tagged``).  ``skip_unchanged`` names the load time's column: rows that
    differ from the target's in nothing else are left out.  ``invalid``: a condition on the scanned rows;
    the keys of those that meet it leave the target, whatever kind of table it is.  ``file_marks``: the folder
    of the source's file marks; the source is a path then, and only files with new rows are opened.
    """
    wm = schemas.WATERMARKS[plan]
    finish_publish(spark, table, root)
    finish_replace(spark, table, root)
    target = spark.table(table).drop(BUCKET_COL, GROUP_COL) if table_exists(spark, table) else None
    bound = stored_watermark(spark, table, wm)
    if target is not None and bound is None:
        bound = watermark_bound(target, wm)
    # An empty target has no bound: everything is new.
    if file_marks is not None:
        if not isinstance(source, str) or partition_col:
            raise ValueError("file marks need a source path, and no partition column")
        found = incremental_files(spark, source, wm, file_marks, bound=bound, lookback=lookback)
        rows = typed_source(found, schema)
    else:
        rows = new_rows(as_source(spark, source), schema, target if bound is not None else None, wm, bound=bound,
                        partition_col=partition_col, lookback=lookback)
    with Scratch(spark) as keep:
        rows = keep(rows, "rows")
        for column, parent, parent_column in references:
            assert_relationships(rows, column, parent, parent_column)
        options = {"watermark": wm, "require_keys": require_keys, "check_schema": check_schema}
        columns = spark.table(table).columns if target is not None else []
        grouped, bucketed = rows_per_group or GROUP_COL in columns, buckets or BUCKET_COL in columns
        one_read = tag is not None and not grouped and not bucketed
        if invalid is not None:
            if one_read:
                raise ValueError("rows that turn invalid do not leave a table that is tagged in the upsert's read")
            if dedupe:      # the newest row of a key says whether it is valid
                rows = keep(latest_per_key(rows, keys, wm), "newest")
            options["gone"] = keep(rows.where(invalid).select(*keys), "gone")
        batch = tag[1](rows) if one_read else build(rows, target)
        if dedupe:      # keep the newest row per key (by watermark) instead of failing
            batch = latest_per_key(batch, keys, wm)
        if skip_unchanged and target is not None:
            batch = keep(batch, "built")
            batch = changed_rows(batch, target, keys, ignore=[skip_unchanged], facts=key_facts(batch, keys))
        if one_read:
            return upsert_tagged(batch, table, keys, tag[0], tag[2], root, **options)
        if grouped:
            return upsert_table_groups(batch, table, keys, root, **options, **({"rows_per_group": rows_per_group} if rows_per_group else {}))
        if bucketed:
            return upsert_table_buckets(batch, table, keys, root, buckets=buckets, **options)
        return upsert_table(batch, table, keys, root, **options)
