"""The keyed incremental load as a Structured Streaming job.

A folder of Parquet files is read as a stream; the stream's checkpoint records which files
are done, so each new file is taken once, whatever its rows' times are: no watermark filter
applies.  Of a micro-batch's rows with one key the newest is taken; a row replaces the
table's row of its key only if it is newer.  So late files, late rows, rows without a time
and several versions of a key in one delivery all end in the newest version of every key.

Replays are safe: a micro-batch writes the version ``v=<stream>-e<epoch>``; if the table
already points at it (the batch finished but its commit was lost) the replay is
skipped, and a half-written version folder is overwritten, never the current one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadsmith import schemas
from loadsmith.operators._sizing import key_facts
from loadsmith.operators.upsert import latest_per_key, upsert_frame
from loadsmith.scratch import Scratch
from loadsmith.sources.sinks import (
    advance_watermark, fitted, stored_watermark, table_exists, table_location, write_snapshot,
)

BuildBatch = Callable[[DataFrame, DataFrame | None], DataFrame]


def newer_than_table(batch: DataFrame, target: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """Rows whose key the target lacks, or holds with an older (or no) ``order_col``."""
    asked = batch.select(*[F.col(k).alias(f"__a{i}") for i, k in enumerate(keys)])
    met = target.join(asked, [F.col(k) == F.col(f"__a{i}") for i, k in enumerate(keys)], "left_semi")
    held = met.groupBy(*[F.col(k).alias(f"__t{i}") for i, k in enumerate(keys)]).agg(
        F.max(order_col).alias("__held"), F.lit(True).alias("__known"))
    same = [F.col(k) == F.col(f"__t{i}") for i, k in enumerate(keys)]
    newer = F.col("__known").isNull() | (F.col(order_col) > F.col("__held")) | \
        (F.col("__held").isNull() & F.col(order_col).isNotNull())
    return batch.join(held, same, "left").where(newer).select(*[F.col(c) for c in batch.columns])


def stream_keyed_load(spark: SparkSession, source_path: str, source_schema: T.StructType,
                      build_batch: BuildBatch, table: str, keys, root: str, watermark: str, *,
                      checkpoint: str, available_now: bool = True, processing_time: str | None = None):
    """Start the stream; returns the ``StreamingQuery`` (already finished when
    ``available_now``).  ``build_batch(rows, target)`` is the plan over all given rows;
    ``checkpoint`` is the stream's own folder, the same on every start."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    # Versions are named by stream (its checkpoint) and epoch, so a restart of
    # the same stream recognizes its own finished batches.
    tag = hashlib.sha1(checkpoint.encode()).hexdigest()[:12]

    def apply(micro: DataFrame, epoch_id: int) -> None:
        version = f"{tag}-e{epoch_id}"
        exists = table_exists(spark, table)
        if exists and table_location(spark, table).rstrip("/").endswith(f"v={version}"):
            return                                          # replay of a finished batch
        target = spark.table(table) if exists else None
        previous = stored_watermark(spark, table, watermark) if exists else None
        if exists and previous is None:
            previous = target.agg(F.max(watermark).cast("string")).first()[0]
        with Scratch(spark) as keep:
            rows = keep(micro, "rows")
            batch = keep(latest_per_key(build_batch(rows, target), keys, watermark), "latest")
            if target is not None:
                batch = newer_than_table(fitted(batch, target), target, keys, watermark)
            batch = keep(batch, "batch")
            facts = key_facts(batch, keys)
            if facts.rows:
                write_snapshot(upsert_frame(target, batch, keys, facts=facts), table, root, run_id=version,
                               replace_version=True)
                advance_watermark(batch, table, watermark, previous)

    writer = (spark.readStream.schema(source_schema).parquet(source_path)
              .writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def stream_validation_stage(spark: SparkSession, source_path: str, table: str, root: str, *, checkpoint: str,
                            as_of=None, source_schema: T.StructType | None = None):
    """The validation-result load over a folder of DATA_SRC_VAL files
    (``source_schema``: the files' schema, by default the declared one)."""
    from loadsmith.plans import validation_stage

    def build(rows, target):
        return validation_stage.build(rows, target, as_of, scan=False)

    return stream_keyed_load(spark, source_path, source_schema or schemas.DATA_SRC_VAL, build, table,
                             [validation_stage.KEY], root,
                             schemas.WATERMARKS[validation_stage.NAME], checkpoint=checkpoint)
