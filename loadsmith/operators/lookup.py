"""Lookup joins (J1-J3), existence flags (J5) and change tags.

All three are left joins that must never change the number of left rows unless asked to.
They are lazy: nothing runs and nothing is written before the result is used.  Catalyst
broadcasts a side whose files are small (``spark.sql.autoBroadcastJoinThreshold``); else
the join shuffles, AQE may still broadcast a side it has measured, and splits hot keys.

Each side is read once and exchanged at most once: a lookup is reduced to one row a key
(with the number of its rows) by an aggregation whose partitioning the join reuses.  Left
rows with a null key cannot match; the left join gives them the defaults, and a partition
that they fill is split like that of any hot key.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadsmith.operators._sizing import fail_on_repeated, not_null


def _key_pairs(on) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    pairs = []
    for item in on:
        pairs.append((item, item) if isinstance(item, str) else (item[0], item[1]))
    return pairs


def _values(values) -> list[tuple[str, str, object]]:
    """Normalize to (output name, lookup column, default)."""
    items = values.items() if isinstance(values, Mapping) else values
    out = []
    for item in items:
        if isinstance(item, str):
            out.append((item, item, None))
            continue
        name, spec = item[0], item[1]
        if isinstance(spec, tuple):
            out.append((name, spec[0], spec[1] if len(spec) > 1 else None))
        else:
            out.append((name, name, spec))
    return out


def lookup_join(df: DataFrame, lookup: DataFrame, on, values, *, on_duplicate: str = "error") -> DataFrame:
    """Left-join ``lookup`` and add its columns with defaults for misses.

    ``on``: a column name, or pairs ``(left_col, lookup_col)``.
    ``values``: ``{out_name: (lookup_col, default)}``; a bare default means the
    lookup column has the output name; ``None`` keeps misses null.
    ``on_duplicate``: ``"error"`` fails the query when a left row meets a lookup key
    that occurs more than once (it would multiply the row); keys that no left row uses
    are not looked at, at any size.  ``"fanout"`` keeps plain SQL semantics.
    Null keys never match.
    """
    if on_duplicate not in ("error", "fanout"):
        raise ValueError("on_duplicate must be 'error' or 'fanout'")
    pairs = _key_pairs(on)
    vals = _values(values)
    lefts = [l for l, _ in pairs]
    lk_names = [f"__lk{i}" for i in range(len(pairs))]
    lv_names = [f"__lv{j}" for j in range(len(vals))]
    lk = lookup.select(*[F.col(r).alias(n) for (_, r), n in zip(pairs, lk_names, strict=True)],
                       *[F.col(src).alias(n) for (_, src, _), n in zip(vals, lv_names, strict=True)])
    lk = lk.where(not_null(lk_names))
    if on_duplicate == "error":
        # One row a key.  Which values it has where a key is repeated never shows: such a match fails.
        n = F.count(F.lit(1))
        lk = lk.groupBy(*lk_names).agg(F.when(n > 1, n).alias("__times"), *[F.first(c).alias(c) for c in lv_names])
    cond = reduce(lambda a, b: a & b, [F.col(l) == F.col(n) for l, n in zip(lefts, lk_names, strict=True)])
    joined = df.join(lk, cond, "left")
    if on_duplicate == "error":
        # After the join: only keys that a left row meets count.
        joined = fail_on_repeated(joined, lefts, "lookup keys must be unique")
    outs = []
    for (name, _, default), n in zip(vals, lv_names, strict=True):
        outs.append((F.col(n) if default is None else F.coalesce(F.col(n), F.lit(default))).alias(name))
    return joined.select(*[F.col(c) for c in df.columns], *outs)


def existence_flag(df: DataFrame, key: str, other: DataFrame, other_key: str | None = None, *,
                   name: str = "EXISTS_FLAG", yes="Y", no="N", probe: str = "other") -> DataFrame:
    """Add ``name`` = ``yes`` when ``df[key]`` occurs among non-null
    ``other[other_key]``, else ``no`` (a null key gives ``no``).

    Same values as ``CASE WHEN key IN (SELECT DISTINCT other_key ...)``, as a
    left join to distinct keys so left rows are never multiplied.  The distinct
    is aggregated map-side first, so a key held by a third of ``other`` costs
    one row per task.

    ``probe="left"`` is for a small ``df`` (an incremental batch) against a large
    ``other``: ``other`` is semi-joined to the keys of ``df`` first, so with a small
    stored batch it streams through a broadcast join and is not shuffled.
    """
    if probe not in ("other", "left"):
        raise ValueError("probe must be 'other' or 'left'")
    ok = other.select(F.col(other_key or key).alias("__ex_k")).where(F.col("__ex_k").isNotNull())
    if probe == "left":
        ok = ok.join(df.select(F.col(key).alias("__ex_k")), "__ex_k", "left_semi")
    hits = ok.distinct().withColumn("__ex_hit", F.lit(True))
    flag = F.when(F.col("__ex_hit").isNotNull(), F.lit(yes)).otherwise(F.lit(no))
    return df.join(hits, F.col(key) == F.col("__ex_k"), "left").select(*[F.col(c) for c in df.columns], flag.alias(name))


def change_tag(batch: DataFrame, target: DataFrame | None, key: str, *, name: str = "__found") -> DataFrame:
    """Add boolean ``name``: does the target already hold a row with ``key``?

    Only existence is used, so a target holding several rows per key does not
    multiply batch rows.  First run (no target): nothing is found.
    """
    if target is None:
        return batch.withColumn(name, F.lit(False))
    return existence_flag(batch, key, target, key, name=name, yes=True, no=False, probe="left")
