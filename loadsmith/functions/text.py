"""String rules.  ``trim`` removes blanks only (not tabs), like SQL ``trim``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadsmith.functions._util import as_col


def upper_trim_or(c, default: str, blank_is_missing: bool = False) -> Column:
    """``upper(trim(c))``; ``default`` for null, and also for blank when asked."""
    c = as_col(c)
    missing = c.isNull()
    if blank_is_missing:
        missing = missing | (F.trim(c) == F.lit(""))
    return F.when(missing, F.lit(default)).otherwise(F.upper(F.trim(c)))


def lower_trim_or(c, default: str) -> Column:
    return F.coalesce(F.lower(F.trim(as_col(c))), F.lit(default))


def at_position(c, needle: str = "@") -> Column:
    """1-based position of ``needle``; 0 when absent, null on null."""
    return F.locate(needle, as_col(c)).cast("long")


def text_length(c) -> Column:
    return F.length(as_col(c)).cast("long")


def prefix(c, n: int) -> Column:
    return as_col(c).substr(1, n)


def email_after_at(c) -> Column:
    """Text after the first ``@``; the whole value when there is none."""
    c = as_col(c)
    return c.substr(F.locate("@", c) + 1, F.length(c))


def email_domain_or(c, default: str) -> Column:
    """Text after the first ``@`` (case kept); ``default`` if none or null."""
    c = as_col(c)
    pos = F.locate("@", c)
    return F.when(pos > 0, c.substr(pos + 1, F.length(c))).otherwise(F.lit(default))


def phone_check(c, null_label: str, short_label: str, min_len: int) -> Column:
    c = as_col(c)
    t = F.trim(c)
    return (F.when(c.isNull(), F.lit(null_label))
            .when(F.length(t) < min_len, F.lit(short_label))
            .otherwise(t))


def remove_char(c, ch: str) -> Column:
    return F.replace(as_col(c), F.lit(ch), F.lit(""))


def concat_strict(*parts) -> Column:
    """Concatenation that is null when any part is null (columns or names)."""
    return F.concat(*[as_col(p) for p in parts])
