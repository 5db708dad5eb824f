"""Employee staging: 35 derived columns, manager flag, label filter.

The label filter (ACTIVE and VALID) is also applied in its raw-column form
first, so it reaches the Parquet scan and shrinks every later step.  The
manager flag is computed against the unfiltered source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadsmith import schemas
from loadsmith.functions import rules
from loadsmith.functions.dates import (
    add_years, date_part, day_diff, dow_sunday0, elapsed_years, run_date, run_timestamp,
    trunc_day, year_diff,
)
from loadsmith.functions.keys import record_hash
from loadsmith.functions.text import (
    at_position, concat_strict, email_after_at, prefix, remove_char, text_length,
)
from loadsmith.operators.lookup import existence_flag
from loadsmith.sources.sinks import write_checked, write_full
from loadsmith.sources.tables import typed_source


def derived_columns(today, run_ts) -> list:
    """G1-G31, G33-G35 on the source column names (G32 comes from a join)."""
    days = day_diff("HIRE_DATE", today)
    return [
        rules.salary_grade().alias("SALARY_GRADE"),
        F.coalesce(F.col("COMMISSION_PCT"), F.lit(0)).alias("COMMISSION_PCT_CLEAN"),
        concat_strict("FIRST_NAME", F.lit(" "), "LAST_NAME").alias("FULL_NAME"),
        run_ts.alias("LOAD_TIMESTAMP"),
        trunc_day("HIRE_DATE").alias("HIRE_DATE_TRUNC"),
        rules.department_name().alias("DEPARTMENT_NAME"),
        prefix("EMAIL", rules.EMAIL_PREFIX_LEN).alias("EMAIL_PREFIX"),
        add_years("HIRE_DATE", 1).alias("FIRST_ANNIVERSARY"),
        year_diff("HIRE_DATE", today).alias("YEARS_OF_SERVICE"),
        rules.is_top_level().alias("IS_TOP_LEVEL"),
        rules.performance_category().alias("PERFORMANCE_CATEGORY"),
        rules.department_id_clean().alias("DEPARTMENT_ID_CLEAN"),
        text_length("PHONE_NUMBER").alias("PHONE_LENGTH"),
        at_position("EMAIL").alias("EMAIL_AT_POSITION"),
        F.upper("EMAIL").alias("EMAIL_UPPER"),
        rules.total_compensation().alias("TOTAL_COMPENSATION"),
        rules.tenure_bonus(today=today).alias("TENURE_BONUS"),
        days.alias("DAYS_EMPLOYED"),
        F.trim("FIRST_NAME").alias("FIRST_NAME_CLEAN"),
        F.trim("LAST_NAME").alias("LAST_NAME_CLEAN"),
        remove_char("PHONE_NUMBER", "-").alias("PHONE_NUMBER_CLEAN"),
        rules.department_group().alias("DEPARTMENT_GROUP"),
        rules.salary_range().alias("SALARY_RANGE"),
        email_after_at("EMAIL").alias("EMAIL_DOMAIN"),
        date_part("quarter", "HIRE_DATE").alias("HIRE_QUARTER"),
        date_part("year", "HIRE_DATE").alias("HIRE_YEAR"),
        date_part("month", "HIRE_DATE").alias("HIRE_MONTH"),
        dow_sunday0("HIRE_DATE").alias("HIRE_DAY_OF_WEEK"),
        elapsed_years(days).alias("EMPLOYMENT_YEARS"),
        rules.salary_percentile().alias("SALARY_PERCENTILE"),
        rules.commission_tier().alias("COMMISSION_TIER"),
        record_hash(*[f.name for f in schemas.EMPLOYEES.fields]).alias("RECORD_HASH"),
        rules.data_quality_flag(today=today).alias("DATA_QUALITY_FLAG"),
        rules.employee_status(today=today).alias("EMPLOYEE_STATUS"),
    ]


def build(employees: DataFrame, as_of=None, *, keep_invalid: bool = False, cast: bool = True) -> DataFrame:
    """Target rows; ``keep_invalid=True`` returns every row with its flags."""
    src = typed_source(employees, schemas.EMPLOYEES, cast=cast)
    today, run_ts = run_date(as_of), run_timestamp(as_of)
    base = src if keep_invalid else src.where(rules.active_valid_pushable(today=today))
    # Manager ids come from the whole source, in one column.
    managers = src.select("MANAGER_ID")
    flagged = existence_flag(base, "EMPLOYEE_ID", managers, "MANAGER_ID", name="IS_MANAGER",
                             yes=rules.YES, no=rules.NO)
    out = flagged.select(*src.columns, "IS_MANAGER", *derived_columns(today, run_ts))
    if not keep_invalid:
        out = out.where((F.col("EMPLOYEE_STATUS") == rules.STATUS_ACTIVE)
                        & (F.col("DATA_QUALITY_FLAG") == rules.QUALITY_VALID))
    return schemas.as_target(out, schemas.STG_EMPLOYEE) if cast else out.select(*schemas.STG_EMPLOYEE_COLS)


def load(employees: DataFrame, table: str, as_of=None, root: str | None = None,
         not_null=(), failing=None) -> None:
    """Rebuild ``table``; with ``root``, as a new version folder (atomic repoint), and with row checks
    (``not_null`` columns, ``failing`` conditions by name) made in the same pass before it is published."""
    if not_null or failing:
        if root is None:
            raise ValueError("checks before publishing need a root for the new version")
        write_checked(build(employees, as_of), table, root, not_null=not_null, failing=failing)
        return
    write_full(build(employees, as_of), table, root)
