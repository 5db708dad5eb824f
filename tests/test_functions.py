
import datetime as dt

from pyspark.sql import functions as F

from loadsmith.functions import (
    add_years, at_position, concat_strict, date_part, day_diff, dow_sunday0, elapsed_years,
    email_after_at, email_domain_or, month_diff, record_hash, run_date, run_timestamp,
    surrogate_key, text_length, trunc_day, upper_trim_or, year_diff,
)


def _one(spark, *cols):
    df = spark.createDataFrame([(dt.date(2020, 12, 31), dt.date(2021, 1, 1), dt.datetime(2024, 6, 16, 23, 0),
                                 dt.date(2020, 2, 29), "a@b@c", None, " x ")],
                               "a date, b date, ts timestamp_ntz, leap date, e string, n string, s string")
    return df.select(*cols).first()


def test_boundary_differences(spark):
    r = _one(spark, year_diff("a", "b").alias("y"), month_diff("a", "b").alias("m"),
             day_diff("a", "b").alias("d"), day_diff(F.col("ts"), F.lit("2024-06-17").cast("date")).alias("d2"))
    assert (r.y, r.m, r.d, r.d2) == (1, 1, 1, 1)


def test_dow_truncation_and_anniversary(spark):
    r = _one(spark, dow_sunday0("ts").alias("dow"), trunc_day("ts").alias("t"), trunc_day("a").alias("ta"),
             add_years("leap", 1).alias("ann"), date_part("quarter", "a").alias("q"))
    assert r.dow == 0                       # 2024-06-16 is a Sunday
    assert r.t == dt.datetime(2024, 6, 16) and r.ta == dt.datetime(2020, 12, 31)
    assert r.ann == dt.date(2021, 2, 28) and r.q == 4


def test_types_are_fixed(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), "x@y")], "d date, e string").select(
        year_diff("d", "d").alias("y"), day_diff("d", "d").alias("dd"), text_length("e").alias("l"),
        at_position("e").alias("p"), elapsed_years(F.lit(400)).alias("ey"), trunc_day("d").alias("t"),
        add_years("d", 1).alias("a"), run_timestamp("2024-06-15 00:00:00").alias("rt"),
        run_date("2024-06-15 00:00:00").alias("rd"))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert types == {"y": "bigint", "dd": "bigint", "l": "bigint", "p": "bigint", "ey": "bigint",
                     "t": "timestamp_ntz", "a": "date", "rt": "timestamp_ntz", "rd": "date"}


def test_text_rules(spark):
    r = _one(spark, email_after_at("e").alias("after"), email_domain_or("n", "dflt").alias("dn"),
             concat_strict("s", F.lit("-"), "n").alias("c"), upper_trim_or("s", "U").alias("u"),
             upper_trim_or(F.lit("  "), "U", blank_is_missing=True).alias("ub"))
    assert r.after == "b@c" and r.dn == "dflt" and r.c is None and r.u == "X" and r.ub == "U"


def test_keys(spark):
    r = _one(spark, surrogate_key("e", "n").alias("k1"), surrogate_key("e", F.lit("_null_")).alias("k2"),
             record_hash("e", "n").alias("h1"), record_hash("e").alias("h2"))
    assert len(r.k1) == 32 and r.k1 == r.k2      # null is the fixed marker
    assert r.h1 == r.h2                          # null hashes as ''
