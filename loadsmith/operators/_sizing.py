"""Key statistics of a stored frame, and the byte bound of a broadcast.

Plans do not probe sizes: Catalyst picks broadcast joins from file statistics and AQE
from measured shuffle bytes.  Writers, which hold a stored batch anyway, take its
statistics in one aggregation and may then broadcast its keys under a byte bound.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadsmith.scratch import materialize, scratch_path  # noqa: F401  (used through this module)

# Distinct keys that may be broadcast: bytes of their values plus a hash table entry each.
BROADCAST_BYTES = 32 << 20
ENTRY_BYTES = 64


def not_null(keys) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


@dataclass(frozen=True)
class KeyFacts:
    """Of a frame's rows: all, with a null key, distinct non-null keys, rows of the most
    frequent one, bytes of the distinct keys in a hash table."""

    rows: int
    null_rows: int
    keys: int
    top: int
    bytes: int

    def fits(self, limit: int = BROADCAST_BYTES) -> bool:
        return self.bytes <= limit


def _width(df: DataFrame, key: str) -> Column:
    kind = df.schema[key].dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.octet_length(key)
    return F.lit(16)


def key_facts(df: DataFrame, keys) -> KeyFacts:
    """One job: counts per key are summed map-side, so a hot key costs one row a task."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    width = reduce(lambda a, b: a + b, [_width(df, k) for k in keys]) + F.lit(ENTRY_BYTES)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")) \
        .select("__n", not_null(keys).alias("__keyed"), width.alias("__w"))
    row = per_key.agg(
        F.sum("__n").alias("rows"), F.sum(F.when(~F.col("__keyed"), F.col("__n"))).alias("loose"),
        F.count_if("__keyed").alias("keys"), F.max(F.when(F.col("__keyed"), F.col("__n"))).alias("top"),
        F.sum(F.when(F.col("__keyed"), F.col("__w"))).alias("bytes")).first()
    return KeyFacts(*(int(row[c] or 0) for c in ("rows", "loose", "keys", "top", "bytes")))


def guard(bad: Column, message: Column) -> Column:
    """A filter condition that keeps every row and fails the query on one where ``bad`` holds."""
    return F.coalesce(F.when(bad, F.raise_error(message).cast("boolean")), F.lit(True))


def shown(keys) -> Column:
    """The values of ``keys`` as text, for messages."""
    return F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])


def mark_repeated(df: DataFrame, keys) -> DataFrame:
    """``df`` with ``__times``: how often the row's key occurs if more than once, else null.

    The keys that occur twice are a relation of their own (one aggregation with map-side
    counts); it is empty in a sound frame, and AQE then drops the join.
    """
    keys = list(keys)
    names = [f"__dup{i}" for i in range(len(keys))]
    twice = df.where(not_null(keys)).groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]) \
        .agg(F.count(F.lit(1)).alias("__times")).where(F.col("__times") > 1)
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(n) for k, n in zip(keys, names, strict=True)])
    return df.join(twice, cond, "left").select(*[F.col(c) for c in df.columns], "__times")


def fail_on_repeated(df: DataFrame, keys, what: str) -> DataFrame:
    """``df`` without ``__times``, failing at run time on a row that has it."""
    message = F.concat(F.lit(f"{what}: key ("), shown(keys), F.lit(") occurs "), F.col("__times").cast("string"), F.lit(" times"))
    return df.where(guard(F.col("__times").isNotNull(), message)).drop("__times")
