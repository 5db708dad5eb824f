"""Keyed upsert as a DataFrame (K2): new keys insert, known keys replace.

``upsert_frame`` is lazy: target rows whose key is in the batch are dropped (anti join)
and the batch is appended.  With the batch's ``KeyFacts`` (of a stored batch) the key check
is done and its keys are broadcast when they fit, so the large target streams through the
anti join with no shuffle; without, the key check is part of the query and Catalyst and AQE
choose the join.  Rows with a null key never match and go around the join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadsmith.operators._sizing import KeyFacts, fail_on_repeated, mark_repeated, not_null
from loadsmith.operators.checks import DataCheckError, assert_same_schema, unique_violations


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def assert_keyed(batch: DataFrame, keys, facts: KeyFacts) -> None:
    """Fail when a non-null key occurs twice in the batch that ``facts`` describe."""
    if facts.top > 1:
        raise DataCheckError(f"batch holds duplicate keys {_names(keys)}: "
                             f"{[r.asDict() for r in unique_violations(batch, keys).limit(5).collect()]}")


def upsert_frame(target: DataFrame | None, batch: DataFrame, keys, *, check_unique: bool = True,
                 check_schema: bool = False, facts: KeyFacts | None = None, gone: DataFrame | None = None) -> DataFrame:
    """The target after applying ``batch``, keyed on ``keys``.

    A null key never matches: such target rows stay and such batch rows are
    appended again on every run.  ``check_unique`` fails on a batch that holds
    a non-null key twice (the result would no longer be keyed): at once with
    ``facts``, else when the result is computed.  ``gone`` holds keys (in columns named as
    ``keys``) whose target rows leave; a batch row under such a key still comes in.  Its keys
    count in ``facts``.
    """
    keys = _names(keys)
    if check_schema:
        assert_same_schema(batch, target)
    if check_unique:
        if facts is not None:
            assert_keyed(batch, keys, facts)
        else:
            batch = fail_on_repeated(mark_repeated(batch, keys), keys, "batch keys must be unique")
    if target is None:
        return batch
    # No distinct: an anti join ignores duplicate keys on its build side.
    names = [f"__bk{i}" for i in range(len(keys))]
    known = batch.where(not_null(keys)).select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)])
    if gone is not None:
        known = known.unionByName(gone.where(not_null(keys)).select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]))
    if facts is not None and facts.fits():
        known = F.broadcast(known)
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.col(n) for k, n in zip(keys, names, strict=True)])
    kept = target.where(not_null(keys)).join(known, cond, "left_anti")
    loose = target.where(~not_null(keys))
    return kept.unionByName(loose).unionByName(batch.select(*target.columns))


def changed_rows(batch: DataFrame, target: DataFrame | None, keys, *, ignore=(), facts: KeyFacts | None = None) -> DataFrame:
    """The batch's rows that an upsert would not repeat: those whose key the target lacks, and those that
    differ from the target's row of that key in a column which both have and ``ignore`` does not name.

    Values are compared, not hashes of them; nulls are equal to nulls.  Rows with a null key match nothing and
    stay.  The target is cut down to the batch's keys before its rows are compared (streamed past them when
    ``facts`` say that they fit a broadcast).
    """
    keys = _names(keys)
    if target is None:
        return batch
    compared = [c for c in batch.columns if c in target.columns and c not in (*keys, *ignore)]
    asked = batch.where(not_null(keys)).select(*[F.col(k).alias(f"__a{i}") for i, k in enumerate(keys)])
    if facts is not None and facts.fits():
        asked = F.broadcast(asked)
    held = target.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *[F.col(c).alias(f"__v{i}") for i, c in enumerate(compared)]) \
        .join(asked, [F.col(f"__k{i}") == F.col(f"__a{i}") for i in range(len(keys))], "left_semi")
    same = [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)] + \
        [F.col(c).eqNullSafe(F.col(f"__v{i}")) for i, c in enumerate(compared)]
    return batch.join(held, reduce(lambda a, b: a & b, same), "left_anti")


def latest_per_key(batch: DataFrame, keys, order_col: str) -> DataFrame:
    """Keep one row per non-null key: the one with the greatest ``order_col``; rows with a
    null key are all kept.

    A null ``order_col`` comes last; ties are settled by the other columns in order (nulls
    last), so the choice is the same on every run.  Spark keeps one row per key and task
    before the shuffle (window group limit), so a hot key costs little.
    """
    keys = _names(keys)
    sortable = [c for c in batch.columns if c not in (*keys, order_col)
                and not isinstance(batch.schema[c].dataType, (T.MapType, T.VariantType))]
    order = [F.col(order_col).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in sortable]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    newest = batch.where(not_null(keys)).withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")
    return newest.unionByName(batch.where(~not_null(keys)))
