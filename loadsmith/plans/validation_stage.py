"""Validation-result staging: incremental keyed upsert with insert/update tag.

watermark scan on LAST_UPDT_TS → surrogate key of (result, source, rule) →
does the target already hold this result id? → LOAD_TS (run time for new ids,
the row's own update time for known ids) → upsert on the surrogate key.

The original looks the target up with a left join on the result id, which
is narrower than the key; only the existence of a match is used, so an
existence test gives the same values without multiplying rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsmith import schemas
from loadsmith.functions import rules
from loadsmith.functions.dates import run_timestamp
from loadsmith.functions.keys import surrogate_key
from loadsmith.operators.lookup import change_tag
from loadsmith.plans._load import new_rows, run_load

NAME = "validation_stage"
KEY = "DATA_SRC_VAL_STAGE_ID"


def keyed(rows: DataFrame) -> DataFrame:
    """The rows with their surrogate key, before the tag."""
    return rows.select(surrogate_key("DATA_SRC_VAL_ID", "DATA_SRC_ID", "VAL_RULE_ID").alias(KEY), *rows.columns)


def finished(tagged: DataFrame, found: str, as_of=None, *, audit: bool = False, cast: bool = True) -> DataFrame:
    """The target's rows from keyed ones and their tag ``found``."""
    out = tagged.select(
        *[c for c in tagged.columns if c != found],
        rules.load_ts_for(F.col(found), run_ts=run_timestamp(as_of)).alias("LOAD_TS"),
        rules.strategy_flag(F.col(found)).alias("UPDATE_STRATEGY_FLAG"),
    )
    if audit:
        return out.select(*schemas.VALIDATION_STAGE_COLS, "UPDATE_STRATEGY_FLAG")
    return schemas.as_target(out, schemas.VALIDATION_STAGE) if cast else out.select(*schemas.VALIDATION_STAGE_COLS)


def build(data_src_val: DataFrame, target: DataFrame | None = None, as_of=None, *,
          bound: str | None = None, partition_col: str | None = None, lookback: str | None = None,
          audit: bool = False, scan: bool = True, cast: bool = True) -> DataFrame:
    """The batch, lazily; ``scan=False`` takes every given row, ``cast=False`` their own types."""
    batch = new_rows(data_src_val, schemas.DATA_SRC_VAL, target, schemas.WATERMARKS[NAME] if scan else None,
                     bound=bound, partition_col=partition_col, lookback=lookback, cast=cast)
    tagged = change_tag(keyed(batch), target, "DATA_SRC_VAL_ID", name="__found")
    return finished(tagged, "__found", as_of, audit=audit, cast=cast)


def load(data_src_val, table: str, root: str, as_of=None, *, buckets: int | None = None, rows_per_group: int | None = None, dedupe: bool = False,
         partition_col: str | None = None, lookback: str | None = None, require_keys: bool = False,
         skip_unchanged: bool = False, file_marks: str | None = None, spark: SparkSession | None = None):
    """Upsert the rows beyond the watermark into ``table``: a new version under ``root`` (one read of
    the target for tag and upsert), or with ``buckets`` a table partitioned by key bucket where only touched buckets are
    rewritten, or with ``rows_per_group`` one of key groups (``sources.key_groups``).  Sources are frames, table names or paths.  A batch holding a key twice
    fails, unless ``dedupe`` keeps the newest row per key (by the watermark column).
    ``partition_col`` names the source's day partition of the watermark, ``lookback`` widens
    the window for late rows, ``require_keys`` refuses null keys, ``skip_unchanged`` leaves rows out that
    differ from the table's in the load time only, ``file_marks`` (a folder) opens only files of
    the source path that hold new rows (``sources.file_marks``)."""
    spark = spark or data_src_val.sparkSession
    return run_load(spark, data_src_val, schemas.DATA_SRC_VAL, NAME, [KEY],
                    lambda rows, target: build(rows, target, as_of, scan=False), table, root,
                    skip_unchanged="LOAD_TS" if skip_unchanged else None, file_marks=file_marks, buckets=buckets, rows_per_group=rows_per_group,
                    dedupe=dedupe, partition_col=partition_col, lookback=lookback, require_keys=require_keys,
                    tag=("DATA_SRC_VAL_ID", keyed, lambda tagged, found: finished(tagged, found, as_of)))
