"""Data checks: not-null, unique, relationships (Q1-Q3).

Each ``*_violations`` function returns the failing rows as a DataFrame (lazy,
distributed); ``assert_*`` raises ``DataCheckError`` when any exist.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DataCheckError(ValueError):
    pass


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def not_null_violations(df: DataFrame, cols) -> DataFrame:
    cols = _names(cols)
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols]))


def unique_violations(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their count ``n``; null keys are ignored.

    Aggregates with a map-side partial count, so one hot key costs one row per
    task in the shuffle, not all of its rows.
    """
    keys = _names(keys)
    nn = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (df.where(nn).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def relationship_violations(child: DataFrame, fk, parent: DataFrame, pk=None) -> DataFrame:
    """Child rows whose non-null foreign key has no parent row."""
    fks = _names(fk)
    pks = _names(pk) if pk is not None else fks
    parent_keys = parent.select(*[F.col(p).alias(f"__pk{i}") for i, p in enumerate(pks)])
    nn = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in fks])
    cond = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__pk{i}") for i, c in enumerate(fks)])
    return child.where(nn).join(parent_keys, cond, "left_anti")


def _raise_if_any(df: DataFrame, what: str) -> None:
    if not df.isEmpty():
        sample = [r.asDict() for r in df.limit(5).collect()]
        raise DataCheckError(f"{what}; first rows: {sample}")


def assert_not_null(df: DataFrame, cols) -> None:
    _raise_if_any(not_null_violations(df, cols), f"null values in {_names(cols)}")


def assert_unique(df: DataFrame, keys) -> None:
    _raise_if_any(unique_violations(df, keys), f"duplicate keys {_names(keys)}")


def assert_relationships(child: DataFrame, fk, parent: DataFrame, pk=None) -> None:
    _raise_if_any(relationship_violations(child, fk, parent, pk),
                  f"orphan foreign keys {_names(fk)}")


def assert_same_schema(df: DataFrame, target: DataFrame | None) -> None:
    """Schema-drift guard: fail when the new rows do not fit the target."""
    if target is None:
        return
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in target.schema.fields]
    if got != want:
        raise DataCheckError(f"schema change: target has {want}, new rows have {got}")
