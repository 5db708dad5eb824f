"""Typed scans (S1, S2) and the watermark-driven incremental scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MissingInputError(LookupError):
    pass


def read_source(spark: SparkSession, name_or_path: str, schema: T.StructType | None = None
                ) -> DataFrame:
    """A catalog table (``db.table``) or a Parquet path, as ``schema`` if one is given
    (``typed_source``); fails clearly when absent."""
    try:
        if "/" in name_or_path or name_or_path.endswith(".parquet"):
            df = spark.read.parquet(name_or_path)
        else:
            df = spark.table(name_or_path)
    except AnalysisException as exc:
        raise MissingInputError(f"input {name_or_path!r} cannot be read: {exc}") from exc
    return df if schema is None else typed_source(df, schema)


def as_source(spark: SparkSession, source: DataFrame | str) -> DataFrame:
    """A source that is given as a frame, a table name or a path."""
    return read_source(spark, source) if isinstance(source, str) else source


def read_lossless(name: str, source: T.DataType, target: T.DataType) -> Column:
    """Column ``name`` as ``target``; the query fails on a value that the cast would change."""
    col = F.col(f"`{name}`")
    if source == target:
        return col
    cast = col.try_cast(target)
    rounds = isinstance(source, (T.FloatType, T.DoubleType)) and isinstance(target, T.DecimalType)
    same = F.lit(True) if rounds or isinstance(source, T.StringType) else cast.try_cast(source).eqNullSafe(col)
    message = F.concat(F.lit(f"{name} does not fit {target.simpleString()}: "), col.cast("string"))
    return F.when(col.isNull(), F.lit(None).cast(target)).when(cast.isNotNull() & same, cast) \
        .otherwise(F.raise_error(message).cast(target)).alias(name)


def typed_source(df: DataFrame, schema: T.StructType | Sequence[str], *, cast: bool = True,
                 keep: Sequence[str] = ()) -> DataFrame:
    """Select the declared columns in order (pruned at the scan), in their declared types.

    Raises ``MissingInputError`` naming every missing column.  A column of another type is
    cast; the query fails on a value that does not fit (binary fractions are rounded to a
    decimal's scale).  Columns that have their type already are passed as they are, so
    filters on them reach the scan.  ``cast=False`` keeps the source's types.  ``keep`` names extra
    columns to carry along (e.g. a partition column used by the scan filter).
    """
    types = {f.name: f.dataType for f in schema.fields} if isinstance(schema, T.StructType) else {}
    names = list(types) or list(schema)
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [n for n in names if n not in have]
    if missing:
        raise MissingInputError(f"input lacks columns {missing}; has {df.columns}")
    extra = [k for k in keep if k not in names]
    if cast and types:
        return df.select(*[read_lossless(n, have[n], types[n]).alias(n) for n in names], *extra)
    return df.select(*names, *extra)


def watermark_bound(target: DataFrame, wm: str) -> str | None:
    """``max(wm)`` over the target as text (exact, time-zone free), or None.

    One global aggregate: a partial max per task and one row to the driver.
    """
    row = target.agg(F.max(F.col(wm)).cast("string").alias("b")).first()
    return None if row is None else row["b"]


def incremental_scan(src: DataFrame, target: DataFrame | None, wm: str, *,
                     lookback: str | None = None, target_wm: str | None = None,
                     bound: str | None = None, partition_col: str | None = None,
                     lazy: bool = False) -> DataFrame:
    """Rows of ``src`` newer than the newest row already in ``target``.

    * no target (first run) or an empty target: the whole source;
    * otherwise ``wm > bound`` (strict), with ``bound`` a literal of the
      column's type so the predicate reaches the Parquet scan (row groups and
      partitions outside the range are skipped);
    * ``lookback`` (e.g. ``"1 HOUR"``) widens the window for late rows; rows
      already loaded are then replaced by the keyed upsert, not duplicated;
    * ``bound``: the high-water mark when the caller already knows it (kept
      as a table property by ``upsert_table``), so the target is not scanned;
    * ``partition_col``: a date partition column holding ``to_date(wm)``; the
      implied ``partition_col >= to_date(bound)`` is added so whole partition
      folders are skipped (rows with ``wm > bound`` can only be there);
    * ``lazy``: without a known ``bound``, compare with a scalar subquery over the target
      instead of running it now; no job starts here, but no row group is skipped either.
    """
    if target is None:
        return src
    if lazy and bound is None:
        newest = target.agg(F.max(F.col(target_wm or wm))).scalar()
        edge = newest - F.expr(f"INTERVAL {lookback}") if lookback else newest
        return src.where(newest.isNull() | (F.col(wm) > edge))
    if bound is None:
        bound = watermark_bound(target, target_wm or wm)
    if bound is None:
        return src
    lit = F.lit(bound).cast(src.schema[wm].dataType)
    if lookback:
        lit = lit - F.expr(f"INTERVAL {lookback}")
    out = src.where(F.col(wm) > lit)
    if partition_col:
        out = out.where(F.col(partition_col) >= F.to_date(lit))
    return out
