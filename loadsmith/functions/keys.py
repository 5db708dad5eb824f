"""Surrogate keys and record hashes (md5, 32 lowercase hex)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadsmith.functions._util import as_col

# Fixed values of the surrogate-key formula: columns are cast to string,
# a null becomes the marker, and the parts are joined with the separator.
SURROGATE_NULL_MARKER = "_null_"
SURROGATE_SEPARATOR = "-"


def surrogate_key(*cols) -> Column:
    parts = [F.coalesce(as_col(c).cast("string"), F.lit(SURROGATE_NULL_MARKER)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


def record_hash(*cols) -> Column:
    """md5 of the columns as strings, null as '', no separator.

    With no separator ('AB','C') and ('A','BC') hash alike; kept on purpose
    so that hashes equal those of the original load.
    """
    parts = [F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat(*parts))
