"""Writers: full rebuild (K1) and keyed upsert (K2, K4) on Parquet tables.

Plain Parquet has no MERGE and must not be overwritten while it is read (the
old files are removed before the read finishes).  So an upsert writes the
new state to a fresh versioned folder and then repoints the catalog table to it:
readers see the old or the new version, never a half-written one, and a job
that dies leaves the current version untouched.  Old versions are left for
the operator's retention job.  Of two upserts that start from one version the second fails
(``ConcurrentWriteError``): the catalog has no compare-and-set, so the repointing is done under
a commit record in ``root``, which a later run finishes when its writer died.

``upsert_table_buckets`` is the scale option: the target is partitioned by a
hash bucket of the key and only the buckets the batch touches are rewritten
(dynamic partition overwrite).  ``key_groups.upsert_table_groups`` rewrites only the files
that hold matching keys.

Nothing is published before it fits: an upsert casts the batch to the table's own
types and fails on a value that a cast would change; a rebuild replaces the schema.
"""

from __future__ import annotations

import time
import uuid
import warnings
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loadsmith.operators._sizing import key_facts, not_null
from loadsmith.operators.checks import DataCheckError, assert_same_schema
from loadsmith.operators.upsert import assert_keyed, upsert_frame
from loadsmith.scratch import Scratch, create_file, list_folders, read_file, remove
from loadsmith.sources.tables import read_lossless


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def write_bucketed(df: DataFrame, table: str, keys, buckets: int, path: str | None = None) -> None:
    """Full rebuild as a catalog table bucketed and sorted by ``keys``: joins and lookups of two tables
    with as many buckets on the same keys need no shuffle of either (``df`` must not read the table).

    Rows are dealt by the buckets' own hash first, so that a bucket is one file; null keys are
    one bucket, as any other key is.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    writer = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def write_checked(df: DataFrame, table: str, root: str, *, not_null=(), failing=None, run_id: str | None = None) -> str:
    """``write_snapshot`` with row checks in the same pass: not-null columns, and ``failing`` conditions by
    name that no row may meet (a null condition is not met).

    The counts are metrics of the write itself (``DataFrame.observe``), so nothing is read twice.  A
    version with a failing row is not published and its folder is removed.
    """
    spark, path = df.sparkSession, _version_path(root, run_id)
    rules = {f"null in {c}": F.col(c).isNull() for c in ([not_null] if isinstance(not_null, str) else not_null)} | dict(failing or {})
    base = table_location(spark, table) if table_exists(spark, table) else ABSENT
    if base != ABSENT and _shape(spark.table(table)) != _shape(df):
        raise DataCheckError(f"schema change: target has {_shape(spark.table(table))}, new rows have {_shape(df)}")
    names = list(rules)
    seen = Observation()
    counts = [F.count_if(rules[name]).alias(f"f{i}") for i, name in enumerate(names)]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).write.parquet(path)
    found = {name: seen.get[f"f{i}"] for i, name in enumerate(names) if seen.get.get(f"f{i}")}
    if found:
        remove(spark, path)
        raise DataCheckError(f"{table} is not published, rows that fail: {found}")
    publish(spark, table, root, path, base)
    return path


def write_full(df: DataFrame, table: str, root: str | None = None, run_id: str | None = None) -> None:
    """Full rebuild: replace the table with ``df``.

    With ``root`` the rows go to a new version folder and the table is
    repointed (readers never see a half-written table); without it the table
    is overwritten in place (``df`` must not read the table).
    """
    if root is not None:
        write_snapshot(df, table, root, run_id)
        return
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def _version_path(root: str, run_id: str | None) -> str:
    return f"{root.rstrip('/')}/v={run_id or uuid.uuid4().hex}"


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


class ConcurrentWriteError(RuntimeError):
    """Another writer changed the table after this one had read it."""


ABSENT = ""      # as an expected location: the table must not exist yet


def _commit_record(root: str) -> str:
    return f"{root.rstrip('/')}/_commit"


def _repoint(spark: SparkSession, table: str, path: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.sql(f"REFRESH TABLE {table}")


def publish(spark: SparkSession, table: str, root: str, path: str, expected: str) -> None:
    """Point ``table`` at ``path`` if it is still at ``expected``, else fail with ``ConcurrentWriteError``.

    ``expected=ABSENT`` creates the table; the catalog refuses a second one.  Else the commit
    record, a file that only one writer can create (as far as the store's exclusive create is
    atomic), covers the comparison and the repointing.
    """
    if expected == ABSENT:
        try:
            spark.catalog.createTable(table, path=path, source="parquet")
        except Exception as failure:
            if table_exists(spark, table):
                raise ConcurrentWriteError(f"{table} was created by another writer; {path} is not published") from failure
            raise
        return
    record = _commit_record(root)
    if not create_file(spark, record, f"{expected}\n{path}\n"):
        raise ConcurrentWriteError(f"another writer is publishing {table} ({record}); {path} is not published")
    try:
        now = table_location(spark, table)
        if now != expected:
            raise ConcurrentWriteError(f"{table} is at {now}, not at {expected} any more; {path} is not published")
        _repoint(spark, table, path)
    finally:
        remove(spark, record)


def finish_publish(spark: SparkSession, table: str, root: str) -> None:
    """End the commit of a writer that died between its record and the repointing.

    The version it names is whole (it was written before the record), so the table moves on to
    it; a record that was not written to its end belongs to a version nobody has seen and goes.
    """
    text = read_file(spark, _commit_record(root))
    if text is None:
        return
    if text.endswith("\n") and text.count("\n") == 2:
        expected, path = text.splitlines()
        if table_exists(spark, table) and table_location(spark, table) == expected:
            _repoint(spark, table, path)
    remove(spark, _commit_record(root))


def write_snapshot(df: DataFrame, table: str, root: str, run_id: str | None = None, *,
                   replace_version: bool = False, expected: str | None = None) -> str:
    """Write ``df`` to a new version folder under ``root`` and point ``table`` at it.

    ``replace_version`` lets a retried run overwrite its own unfinished version
    folder (never the one the table points at).  With ``expected``, the location that ``df``
    was made from (or ``ABSENT``), the table is repointed only from there (``publish``).
    """
    spark = df.sparkSession
    path = _version_path(root, run_id)
    if replace_version and table_exists(spark, table) and \
            table_location(spark, table).rstrip("/").endswith(path.rstrip("/").split("/")[-1]):
        raise ValueError(f"{path} is the current version of {table}")
    df.write.mode("overwrite" if replace_version else "errorifexists").parquet(path)
    if expected is not None:
        publish(spark, table, root, path, expected)
        return path
    if table_exists(spark, table) and _shape(spark.table(table)) == _shape(df):
        _repoint(spark, table, path)
        return path
    if table_exists(spark, table):          # another schema: the table follows its new version
        spark.sql(f"DROP TABLE {table}")    # external: its files stay
    spark.catalog.createTable(table, path=path, source="parquet")
    return path


def _shape(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def remove_old_versions(spark: SparkSession, table: str, root: str, *, keep: int = 1, min_age_hours: float = 24) -> list[str]:
    """Remove version folders under ``root`` that ``table`` does not point at; returns them.

    A version that was replaced less than ``min_age_hours`` ago stays, since a query that began before
    may still read it (take the time longer than any query and any load), as do the ``keep`` newest of the
    others.  A version counts as replaced when the next one was written; folders of writers that
    failed go by the same rule.
    """
    current = table_location(spark, table)
    versions = sorted((when, path) for path, when in list_folders(spark, root) if path.rsplit("/", 1)[-1].startswith("v="))
    replaced = [(versions[i + 1][0] if i + 1 < len(versions) else when, path) for i, (when, path) in enumerate(versions)
                if current != path and not current.startswith(f"{path}/")]
    edge = time.time() - min_age_hours * 3600
    old = [path for when, path in replaced[:max(0, len(replaced) - keep)] if when < edge]
    for path in old:
        remove(spark, path)
    return old


def fitted(batch: DataFrame, target: DataFrame) -> DataFrame:
    """``batch`` with the columns and types of ``target``: refused when a column is missing or
    extra; the write fails on a value that does not fit its type unchanged."""
    if set(batch.columns) != set(target.columns):
        raise DataCheckError(f"schema change: target has {_shape(target)}, new rows have {_shape(batch)}")
    return batch.select(*[read_lossless(f.name, batch.schema[f.name].dataType, f.dataType).alias(f.name)
                          for f in target.schema.fields])


WATERMARK_PROPERTY = "loadsmith.watermark."
BUCKETS_PROPERTY = "loadsmith.buckets"
BUCKET_COL = "_key_bucket"


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def stored_watermark(spark: SparkSession, table: str, wm: str) -> str | None:
    """The high-water mark of ``wm`` recorded by the last load, if it is of the version that
    the table points at now; a table that was pointed elsewhere has none."""
    if not table_exists(spark, table):
        return None
    props = properties(spark, table)
    if props.get(f"{WATERMARK_PROPERTY}{wm}.version") != table_location(spark, table):
        return None
    return props.get(WATERMARK_PROPERTY + wm)


def record_watermark(spark: SparkSession, table: str, wm: str, value: str | None) -> None:
    if value is not None:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{WATERMARK_PROPERTY}{wm}' = '{value}', "
                  f"'{WATERMARK_PROPERTY}{wm}.version' = '{table_location(spark, table)}')")


def advance_watermark(batch: DataFrame, table: str, wm: str, previous: str | None) -> None:
    """Record the larger of the previous mark and the (small) batch's maximum."""
    record_watermark(batch.sparkSession, table, wm, newest_mark(batch, wm, previous))


def newest_mark(batch: DataFrame, wm: str, previous: str | None) -> str | None:
    """The larger of the previous mark and the batch's maximum, compared in the column's type."""
    known = F.lit(previous).cast(batch.schema[wm].dataType)
    return batch.agg(F.greatest(F.max(F.col(wm)), known).cast("string").alias("m")).first()["m"]


MERGE_PROVIDERS = ("delta", "iceberg", "hudi")


def table_provider(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return next((r["data_type"] for r in rows if r["col_name"] == "Provider"), "").lower()


def merge_into(batch: DataFrame, table: str, keys) -> None:
    """``MERGE INTO`` for table formats that support it (known key replaces the
    row, new key inserts).  The batch is matched on all ``keys``."""
    spark = batch.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    provider = table_provider(spark, table)
    if provider not in MERGE_PROVIDERS:
        raise ValueError(f"{table} is a {provider or 'unknown'} table; MERGE needs one of "
                         f"{MERGE_PROVIDERS}; use upsert_table")
    view = f"loadsmith_batch_{uuid.uuid4().hex}"
    batch.createOrReplaceTempView(view)
    on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    try:
        spark.sql(f"MERGE INTO {table} t USING {view} s ON {on} "
                  f"WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *")
    finally:
        spark.catalog.dropTempView(view)


def checked_keys(batch: DataFrame, table: str, keys: list[str], require_keys: bool):
    """Key facts of a stored batch, after the key checks."""
    facts = key_facts(batch, keys)
    assert_keyed(batch, keys, facts)
    if facts.null_rows and require_keys:
        raise DataCheckError(f"batch for {table} has {facts.null_rows} rows with a null key {keys}")
    if facts.null_rows:
        warnings.warn(f"batch for {table} has rows with a null key {keys}; they never match "
                      f"and are appended on every run", stacklevel=3)
    return facts


def leaving_keys(gone: DataFrame, target: DataFrame, keys: list[str], facts):
    """The non-null keys of ``gone`` (None if it has none) in the target's types, and the batch's key facts
    with their bytes added."""
    leaving = key_facts(gone, keys)
    if not leaving.keys:
        return None, facts
    typed = [read_lossless(k, gone.schema[k].dataType, target.schema[k].dataType).alias(k) for k in keys]
    return gone.where(not_null(keys)).select(*typed), replace(facts, bytes=facts.bytes + leaving.bytes)


def upsert_table(batch: DataFrame, table: str, keys, root: str, *, check_schema: bool = False,
                 run_id: str | None = None, watermark: str | None = None, method: str = "auto",
                 require_keys: bool = False, check=None, gone: DataFrame | None = None) -> str:
    """Apply ``batch`` to ``table`` keyed on ``keys``; create it on the first run.

    ``method``: ``"merge"`` (MERGE INTO, for formats that support it),
    ``"snapshot"`` (new version folder + repoint, for plain Parquet) or
    ``"auto"`` (merge when the table's provider supports it).
    The batch is written once to a scratch table, which is removed at the end; checks,
    key statistics and the write read it.  ``check_schema`` refuses any other schema than
    the table's, else the batch is cast to it and a value that does not fit fails the write.
    ``require_keys`` refuses null keys; ``check`` is called with the stored batch before
    anything is published.  With ``watermark``, the new high-water mark (the larger of the
    recorded one and the batch's maximum) is recorded with the version that holds it.
    Of two writers that start from one version the second fails with ``ConcurrentWriteError``.
    ``gone`` (a stored frame of keys) names rows that leave the table (``upsert_frame``).
    """
    spark = batch.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    exists = table_exists(spark, table)
    base = table_location(spark, table) if exists else ABSENT
    target = spark.table(table) if exists else None
    if exists and check_schema:
        assert_same_schema(batch, target)
    previous = stored_watermark(spark, table, watermark) if watermark and exists else None
    if exists and watermark and previous is None:
        previous = target.agg(F.max(watermark).cast("string")).first()[0]
    with Scratch(spark) as keep:
        batch = keep(batch if target is None else fitted(batch, target), "batch")
        facts = checked_keys(batch, table, keys, require_keys)
        if check is not None:
            check(batch)
        if gone is not None:
            gone, facts = leaving_keys(gone, batch, keys, facts)
        if exists and not facts.rows and gone is None:
            return table_location(spark, table)      # nothing new: no rewrite of the target
        if method == "auto":
            method = "merge" if exists and table_provider(spark, table) in MERGE_PROVIDERS else "snapshot"
        if method == "merge":
            if gone is not None:
                raise ValueError("keys that leave need method='snapshot'")
            merge_into(batch, table, keys)
            path = table_location(spark, table)
        elif method == "snapshot":
            path = write_snapshot(upsert_frame(target, batch, keys, facts=facts, gone=gone), table, root, run_id, expected=base)
        else:
            raise ValueError("method must be 'auto', 'merge' or 'snapshot'")
        if watermark:
            advance_watermark(batch, table, watermark, previous)
        return path


LOOSE_ROWS = 1_000_000      # rows with a null key in a bucket of their own


def key_bucket(keys, buckets: int):
    """Bucket of a key: 0 and up by its hash; rows with a null key are dealt over as many
    buckets below 0, by chance, since they are only ever appended."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    hashed = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets))
    loose = -1 - F.floor(F.rand(11) * buckets)
    return F.when(not_null(keys), hashed).otherwise(loose).cast("int")


def upsert_table_buckets(batch: DataFrame, table: str, keys, path: str, *, buckets: int | None = None,
                         watermark: str | None = None, check_schema: bool = False,
                         require_keys: bool = False, check=None, gone: DataFrame | None = None) -> None:
    """Upsert that rewrites only the key buckets present in the batch (and in ``gone``, keys whose rows leave).

    The table is stored partitioned by ``_key_bucket``, the hash of the key modulo
    ``buckets``.  That number is given when the table is created (take it so that a bucket
    is a few hundred MB) and kept as a table property; a later call takes it from there and
    refuses another one.  The target read is pruned to the touched buckets (a partition
    filter of at most ``buckets`` values), the upsert runs per bucket, and dynamic partition
    overwrite replaces just those partitions.  Rows with a null key are put into new buckets
    of their own (below all others) and never read or rewritten.  Keyed and null-key rows and the
    watermark are one commit (``sources.redo``).  Other options as in ``upsert_table``.
    """
    from loadsmith.sources import redo

    spark = batch.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    exists = table_exists(spark, table)
    if exists:
        redo.finish_replace(spark, table, path)
        base = redo.last_commit(spark, table)
        stored = properties(spark, table).get(BUCKETS_PROPERTY)
        if stored is None or buckets not in (None, int(stored)):
            raise ValueError(f"{table} is stored in {stored or 'no'} key buckets, not {buckets}")
        buckets = int(stored)
    elif not buckets:
        raise ValueError("a new table needs its number of key buckets")
    target = spark.table(table) if exists else None
    if exists and check_schema:
        assert_same_schema(batch, target.drop(BUCKET_COL))
    previous = stored_watermark(spark, table, watermark) if watermark and exists else None
    if exists and watermark and previous is None:
        previous = target.agg(F.max(watermark).cast("string")).first()[0]
    with Scratch(spark) as keep:
        fit = batch if target is None else fitted(batch, target.drop(BUCKET_COL))
        batch = keep(fit.withColumn(BUCKET_COL, key_bucket(keys, buckets)), "batch")
        facts = checked_keys(batch, table, keys, require_keys)
        if check is not None:
            check(batch.drop(BUCKET_COL))
        if gone is not None and exists:
            gone, facts = leaving_keys(gone, target, keys, facts)
        if not exists:
            (batch.hint("rebalance", BUCKET_COL).write.partitionBy(BUCKET_COL).format("parquet")
             .option("path", path).saveAsTable(table))
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{BUCKETS_PROPERTY}' = '{buckets}')")
            if watermark:
                advance_watermark(batch, table, watermark, previous)
        elif facts.rows or gone is not None:
            at = batch.where(F.col(BUCKET_COL) >= 0).select(BUCKET_COL)
            if gone is not None:
                gone = gone.withColumn(BUCKET_COL, key_bucket(keys, buckets))
                at = at.unionByName(gone.select(BUCKET_COL))
            touched = sorted(r[0] for r in at.distinct().collect())
            held = target.where(F.col(BUCKET_COL).isin(touched))
            keyed = batch.where(F.col(BUCKET_COL) >= 0).select(*target.columns)
            result = upsert_frame(held, keyed, [*keys, BUCKET_COL], check_unique=False, facts=facts, gone=gone)
            if facts.null_rows:
                lowest = min([0, *redo.partition_ids(spark, table)])
                spread = -(-facts.null_rows // LOOSE_ROWS)
                loose = batch.where(F.col(BUCKET_COL) < 0).withColumn(
                    BUCKET_COL, (lowest - 1 - F.floor(F.rand(11) * spread)).cast("int"))
                result = result.unionByName(loose)
            redo.replace_partitions(result.select(*target.columns), table, path, expected=base, watermark=watermark,
                                    mark=newest_mark(batch, watermark, previous) if watermark else None,
                                    replaced=touched if gone is not None else ())
