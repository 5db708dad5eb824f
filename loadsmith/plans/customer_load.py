"""Customer staging load: incremental keyed upsert with country lookup.

The lookup joins on the raw country code, while the output code defaults to
US afterwards: a null country gives US with the lookup defaults.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsmith import schemas
from loadsmith.functions import rules
from loadsmith.functions.dates import month_diff, run_date, run_timestamp, trunc_day
from loadsmith.functions.keys import surrogate_key
from loadsmith.functions.text import email_domain_or
from loadsmith.operators.lookup import lookup_join
from loadsmith.plans._load import new_rows, run_load
from loadsmith.sources.tables import as_source, typed_source

NAME = "customer_load"


def build(customer_raw: DataFrame, dim_country: DataFrame, target: DataFrame | None = None,
          as_of=None, *, bound: str | None = None, partition_col: str | None = None,
          lookback: str | None = None, scan: bool = True, cast: bool = True) -> DataFrame:
    """The batch, lazily; ``scan=False`` takes every given row, ``cast=False`` their own types."""
    batch = new_rows(customer_raw, schemas.CUSTOMER_RAW, target, schemas.WATERMARKS[NAME] if scan else None,
                     bound=bound, partition_col=partition_col, lookback=lookback, cast=cast)
    today, run_ts = run_date(as_of), run_timestamp(as_of)
    joined = lookup_join(batch, typed_source(dim_country, schemas.DIM_COUNTRY, cast=cast),
                         [("COUNTRY", "COUNTRY_CODE")],
                         {name: (name, default) for name, default in rules.COUNTRY_DEFAULTS})
    out = joined.select(
        "CUSTOMER_ID",
        rules.staged_name("FIRST_NAME").alias("FIRST_NAME"),
        rules.staged_name("LAST_NAME").alias("LAST_NAME"),
        rules.staged_full_name().alias("FULL_NAME"),
        rules.staged_email().alias("EMAIL"),
        email_domain_or("EMAIL", rules.EMAIL_DOMAIN_DEFAULT).alias("EMAIL_DOMAIN"),
        *[F.coalesce(F.col(c), F.lit(d)).alias(c) for c, d in rules.CONTACT_DEFAULTS],
        F.coalesce(F.col("COUNTRY"), F.lit(rules.COUNTRY_CODE_DEFAULT)).alias("COUNTRY_CODE"),
        "COUNTRY_NAME", "REGION", "CURRENCY_CODE",
        rules.customer_type().alias("CUSTOMER_TYPE"),
        F.coalesce(F.col("CREDIT_LIMIT"), F.lit(0)).alias("CREDIT_LIMIT"),
        F.coalesce(F.col("ACCOUNT_BALANCE"), F.lit(0)).alias("ACCOUNT_BALANCE"),
        rules.credit_utilization_pct().alias("CREDIT_UTILIZATION_PCT"),
        rules.risk_category().alias("RISK_CATEGORY"),
        "REGISTRATION_DATE", "LAST_PURCHASE_DATE",
        trunc_day("REGISTRATION_DATE").alias("REGISTRATION_DATE_KEY"),
        rules.days_since("LAST_PURCHASE_DATE", today).alias("DAYS_SINCE_LAST_PURCHASE"),
        rules.lifecycle_status(today=today).alias("LIFECYCLE_STATUS"),
        month_diff("REGISTRATION_DATE", today).alias("CUSTOMER_TENURE_MONTHS"),
        "CREATED_DATE", "UPDATED_DATE",
        run_ts.alias("DW_LOAD_TIMESTAMP"),
        surrogate_key("CUSTOMER_ID", "UPDATED_DATE").alias("DW_RECORD_KEY"),
    )
    return schemas.as_target(out, schemas.CUSTOMER_LOAD) if cast else out.select(*schemas.CUSTOMER_LOAD_COLS)


def load(customer_raw, dim_country, table: str, root: str, as_of=None, *, buckets: int | None = None, rows_per_group: int | None = None,
         dedupe: bool = False, partition_col: str | None = None, lookback: str | None = None,
         require_keys: bool = False, require_countries: bool = False, skip_unchanged: bool = False, file_marks: str | None = None, spark: SparkSession | None = None):
    """Upsert the rows beyond the watermark into ``table``: a new version under ``root``,
    or with ``buckets`` a table partitioned by key bucket where only touched buckets are
    rewritten, or with ``rows_per_group`` one of key groups (``sources.key_groups``).  Sources are frames, table names or paths.  A batch holding a key twice
    fails, unless ``dedupe`` keeps the newest row per key (by the watermark column).
    ``partition_col`` names the source's day partition of the watermark, ``lookback`` widens
    the window for late rows, ``require_keys`` refuses null keys, ``skip_unchanged`` leaves rows out that
    differ from the table's in the load time only, ``file_marks`` (a folder) opens only files of
    the source path that hold new rows (``sources.file_marks``),
    ``require_countries`` a country code without a row in the dimension."""
    spark = spark or customer_raw.sparkSession
    dim = as_source(spark, dim_country)
    return run_load(spark, customer_raw, schemas.CUSTOMER_RAW, NAME, schemas.KEYS[NAME],
                    lambda rows, target: build(rows, dim, target, as_of, scan=False), table, root,
                    skip_unchanged="DW_LOAD_TIMESTAMP" if skip_unchanged else None, file_marks=file_marks,
                    buckets=buckets, rows_per_group=rows_per_group, dedupe=dedupe, partition_col=partition_col, lookback=lookback,
                    require_keys=require_keys, references=[("COUNTRY", dim, "COUNTRY_CODE")] if require_countries else [])
