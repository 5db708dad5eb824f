"""Column-level building blocks.  Everything here returns a ``Column``."""

from loadsmith.functions.codes import decode, first_match, group_of
from loadsmith.functions.dates import (
    add_years, date_part, day_diff, dow_sunday0, elapsed_years, month_diff,
    run_date, run_timestamp, trunc_day, year_diff,
)
from loadsmith.functions.keys import record_hash, surrogate_key
from loadsmith.functions.text import (
    at_position, concat_strict, email_after_at, email_domain_or, lower_trim_or,
    phone_check, prefix, remove_char, text_length, upper_trim_or,
)

__all__ = [
    "decode", "first_match", "group_of", "add_years", "date_part", "day_diff",
    "dow_sunday0", "elapsed_years", "month_diff", "run_date", "run_timestamp",
    "trunc_day", "year_diff", "record_hash", "surrogate_key", "at_position",
    "concat_strict", "email_after_at", "email_domain_or", "lower_trim_or",
    "phone_check", "prefix", "remove_char", "text_length", "upper_trim_or",
]
