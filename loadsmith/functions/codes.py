"""Code decoding and banding: ordered CASE chains as Columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadsmith.functions._util import as_col


def first_match(branches: Sequence[tuple[Column, object]], default=None) -> Column:
    """Searched CASE: the first true condition wins; ``default`` otherwise.

    A ``default`` of ``None`` leaves the ELSE branch null.
    """
    out = None
    for cond, value in branches:
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, v) if out is None else out.when(cond, v)
    if default is None:
        return out
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def decode(c, pairs: Iterable[tuple[object, object]], default=None) -> Column:
    """Simple CASE ``c WHEN k THEN v``."""
    c = as_col(c)
    return first_match([(c == F.lit(k), v) for k, v in pairs], default)


def group_of(c, groups: Iterable[tuple[object, Sequence[object]]], default=None) -> Column:
    """CASE WHEN c IN (...) THEN label, in order."""
    c = as_col(c)
    return first_match([(c.isin(list(members)), label) for label, members in groups], default)
