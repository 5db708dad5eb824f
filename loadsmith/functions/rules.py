"""Business rules of the five load plans, one function per derived column.

Each rule takes the input column names (defaulting to the source names of the
plan) and returns a ``Column``; plans and the registered queries share them.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadsmith.functions.codes import decode, first_match, group_of
from loadsmith.functions.dates import day_diff, year_diff
from loadsmith.functions.text import lower_trim_or, upper_trim_or

# ---------------------------------------------------------------------------
# Labels, codes, thresholds and defaults that must equal the
# original load logic.  Listed in the order the rules test them.
# ---------------------------------------------------------------------------
UNKNOWN = "UNKNOWN"

# employees (full-rebuild staging plan)
SALARY_GRADES = [(10000, "High"), (5000, "Medium")]            # strict >, else "Low"
SALARY_GRADE_ELSE = "Low"
JOB_DEPARTMENT_NAMES = [("IT_PROG", "Information Technology"), ("SA_REP", "Sales"),
                        ("ST_CLERK", "Stock Management"), ("FI_ACCOUNT", "Finance")]
JOB_DEPARTMENT_ELSE = "Other"
EMAIL_PREFIX_LEN = 10
STAR_SALARY, STAR_COMMISSION, STAR_LABEL = 15000, 0.2, "Star Performer"   # both strict >
PERFORMANCE = [(10000, "High Performer"), (5000, "Average Performer")]      # strict >
PERFORMANCE_ELSE = "Entry Level"
DEPARTMENT_ID_DEFAULT = -1
TENURE_BONUS_RATES = [(10, "0.15"), (5, "0.10"), (2, "0.05")]   # decimals; years strict >, else 0
JOB_GROUPS = [("IT", ["IT_PROG", "IT_SUPPORT"]), ("SALES", ["SA_REP", "SA_MAN"]),
              ("FINANCE", ["FI_ACCOUNT", "FI_MGR"]), ("OPERATIONS", ["ST_CLERK", "ST_MAN"])]
JOB_GROUP_ELSE = "ADMIN"
SALARY_RANGES = [(0, 5000, "0-5K"), (5001, 10000, "5K-10K"),
                 (10001, 15000, "10K-15K"), (15001, 20000, "15K-20K")]   # inclusive
SALARY_RANGE_ELSE = "20K+"
SALARY_PERCENTILES = [(20000, "Top 10%"), (15000, "Top 25%"), (10000, "Top 50%")]  # >=
SALARY_PERCENTILE_ELSE = "Bottom 50%"
COMMISSION_TIERS = [(0.30, "Tier 1"), (0.20, "Tier 2"), (0.10, "Tier 3")]  # >=; then > 0 "Tier 4"
COMMISSION_TIER_ANY = "Tier 4"
COMMISSION_TIER_ELSE = "No Commission"
QUALITY_INCOMPLETE, QUALITY_BAD_SALARY, QUALITY_FUTURE, QUALITY_VALID = (
    "INCOMPLETE", "INVALID_SALARY", "FUTURE_HIRE_DATE", "VALID")
STATUS_ACTIVE, STATUS_INACTIVE = "ACTIVE", "INACTIVE"
YES, NO = "Y", "N"

# customer master plan
NO_EMAIL_MASTER = "noemail@unknown.com"
NO_PHONE, BAD_PHONE, PHONE_MIN_LEN = "NO-PHONE", "INVALID-PHONE", 10
ADDRESS_DEFAULTS = [("STREET", UNKNOWN), ("CITY", UNKNOWN), ("STATE", UNKNOWN),
                    ("ZIP_CODE", "00000"), ("COUNTRY", UNKNOWN)]
MASTER_STATUS = [("A", "ACTIVE"), ("I", "INACTIVE"), ("S", "SUSPENDED")]
MASTER_STATUS_ELSE = UNKNOWN
MASTER_KEEP_STATUS = ["ACTIVE", "INACTIVE"]

# customer staging plan
NO_EMAIL_RAW = "no-email@unknown.com"
EMAIL_DOMAIN_DEFAULT = "unknown.com"
CONTACT_DEFAULTS = [("PHONE", UNKNOWN), ("ADDRESS", UNKNOWN), ("CITY", UNKNOWN),
                    ("STATE", UNKNOWN), ("ZIP_CODE", "00000")]
COUNTRY_CODE_DEFAULT = "US"
COUNTRY_DEFAULTS = [("COUNTRY_NAME", "Unknown Country"), ("REGION", "Unknown Region"),
                    ("CURRENCY_CODE", "USD")]
CUSTOMER_TYPES = [("R", "RETAIL"), ("W", "WHOLESALE"), ("C", "CORPORATE")]
CUSTOMER_TYPE_ELSE = "OTHER"
RISK_NONE = "NO_CREDIT"
RISK_LEVELS = [(0.9, "HIGH_RISK"), (0.7, "MEDIUM_RISK")]        # strict >
RISK_ELSE = "LOW_RISK"
ACTIVE_WINDOW_DAYS = 90
LIFECYCLE = [("S", "SUSPENDED"), ("C", "CLOSED")]
LIFECYCLE_ACTIVE, LIFECYCLE_INACTIVE, LIFECYCLE_ELSE = "ACTIVE", "INACTIVE", UNKNOWN

# validation-result plan
INSERT_FLAG, UPDATE_FLAG = 0, 1
# ---------------------------------------------------------------------------


def _c(name) -> Column:
    return F.col(name) if isinstance(name, str) else name


# --- employees: full-rebuild EMP plan (E1, E2) ------------------------------

def comm_adjusted(comm="COMM") -> Column:
    """Null commission → 0."""
    return F.coalesce(_c(comm), F.lit(0))


def total_comp(sal="SAL", comm="COMM") -> Column:
    """Salary plus commission; null when salary is null."""
    return _c(sal) + F.coalesce(_c(comm), F.lit(0))


# --- employees: staging plan (G1-G35) ---------------------------------------

def salary_grade(salary="SALARY") -> Column:
    s = _c(salary)
    return first_match([(s > t, label) for t, label in SALARY_GRADES], SALARY_GRADE_ELSE)


def department_name(job="JOB_ID") -> Column:
    return decode(job, JOB_DEPARTMENT_NAMES, JOB_DEPARTMENT_ELSE)


def performance_category(salary="SALARY", commission="COMMISSION_PCT") -> Column:
    s = _c(salary)
    star = (s > STAR_SALARY) & (F.coalesce(_c(commission), F.lit(0)) > STAR_COMMISSION)
    rest = [(s > t, label) for t, label in PERFORMANCE]
    return first_match([(star, STAR_LABEL)] + rest, PERFORMANCE_ELSE)


def department_id_clean(dept="DEPARTMENT_ID") -> Column:
    return F.coalesce(_c(dept), F.lit(DEPARTMENT_ID_DEFAULT))


def total_compensation(salary="SALARY", commission="COMMISSION_PCT") -> Column:
    return _c(salary) * (F.lit(1) + F.coalesce(_c(commission), F.lit(0)))


def tenure_bonus(salary="SALARY", hire_date="HIRE_DATE", today=None) -> Column:
    years = year_diff(hire_date, today)
    s = _c(salary)
    return first_match([(years > y, s * F.lit(Decimal(rate))) for y, rate in TENURE_BONUS_RATES], F.lit(0))


def department_group(job="JOB_ID") -> Column:
    return group_of(job, JOB_GROUPS, JOB_GROUP_ELSE)


def salary_range(salary="SALARY") -> Column:
    s = _c(salary)
    return first_match([(s.between(lo, hi), label) for lo, hi, label in SALARY_RANGES],
                       SALARY_RANGE_ELSE)


def salary_percentile(salary="SALARY") -> Column:
    s = _c(salary)
    return first_match([(s >= t, label) for t, label in SALARY_PERCENTILES],
                       SALARY_PERCENTILE_ELSE)


def commission_tier(commission="COMMISSION_PCT") -> Column:
    c = F.coalesce(_c(commission), F.lit(0))
    branches = [(c >= F.lit(t), label) for t, label in COMMISSION_TIERS]
    branches.append((c > 0, COMMISSION_TIER_ANY))
    return first_match(branches, COMMISSION_TIER_ELSE)


def is_top_level(manager="MANAGER_ID") -> Column:
    return F.when(_c(manager).isNull(), YES).otherwise(NO)


def data_quality_flag(email="EMAIL", phone="PHONE_NUMBER", hire_date="HIRE_DATE",
                      salary="SALARY", today=None) -> Column:
    h = _c(hire_date)
    return first_match([
        (_c(email).isNull() | _c(phone).isNull() | h.isNull(), QUALITY_INCOMPLETE),
        (_c(salary) <= 0, QUALITY_BAD_SALARY),
        (h > today, QUALITY_FUTURE),
    ], QUALITY_VALID)


def employee_status(salary="SALARY", hire_date="HIRE_DATE", today=None) -> Column:
    return F.when((_c(salary) > 0) & (_c(hire_date) <= today), STATUS_ACTIVE).otherwise(STATUS_INACTIVE)


def active_valid_pushable(email="EMAIL", phone="PHONE_NUMBER", hire_date="HIRE_DATE",
                          salary="SALARY", today=None) -> Column:
    """Raw-column predicate equal to ``status = ACTIVE and flag = VALID``.

    Written on source columns only, so it reaches the Parquet scan.
    """
    return (_c(email).isNotNull() & _c(phone).isNotNull()
            & (_c(salary) > 0) & (_c(hire_date) <= today))


# --- customer master plan (C1-C13) ------------------------------------------

def master_name(c) -> Column:
    """Null → UNKNOWN; a blank stays ''."""
    return upper_trim_or(c, UNKNOWN, blank_is_missing=False)


def master_email(email="EMAIL") -> Column:
    return lower_trim_or(email, NO_EMAIL_MASTER)


def master_status(status="STATUS") -> Column:
    return decode(status, MASTER_STATUS, MASTER_STATUS_ELSE)


def update_flag(modified="LAST_MODIFIED_DATE", registered="REGISTRATION_DATE") -> Column:
    """1 when modified after registration, else 0 (nulls give 0)."""
    return F.when(_c(modified) > _c(registered), F.lit(UPDATE_FLAG)).otherwise(F.lit(INSERT_FLAG))


def master_valid_pushable(customer_id="CUSTOMER_ID", email="EMAIL", status="STATUS",
                          registered="REGISTRATION_DATE") -> Column:
    """Raw-column predicate equal to the valid-customer filter on derived columns."""
    codes = [code for code, label in MASTER_STATUS if label in MASTER_KEEP_STATUS]
    return (_c(customer_id).isNotNull() & _c(email).isNotNull()
            & _c(status).isin(codes) & _c(registered).isNotNull()
            & (F.lower(F.trim(_c(email))) != F.lit(NO_EMAIL_MASTER)))


def master_valid_labels(customer_id="CUSTOMER_ID", email="EMAIL", status="STATUS",
                        registered="REGISTRATION_DATE") -> Column:
    """The valid-customer filter as written, on the derived columns."""
    return (_c(customer_id).isNotNull() & (_c(email) != F.lit(NO_EMAIL_MASTER))
            & _c(status).isin(MASTER_KEEP_STATUS) & _c(registered).isNotNull())


# --- customer staging plan (L1-L25) -----------------------------------------

def staged_name(c) -> Column:
    """L1/L2: null or blank → UNKNOWN."""
    return upper_trim_or(c, UNKNOWN, blank_is_missing=True)


def staged_full_name(first="FIRST_NAME", last="LAST_NAME") -> Column:
    """L3: both parts default to '' so the result is never null."""
    part = lambda c: F.upper(F.trim(F.coalesce(_c(c), F.lit(""))))
    return F.concat(part(first), F.lit(" "), part(last))


def staged_email(email="EMAIL") -> Column:
    return lower_trim_or(email, NO_EMAIL_RAW)


def customer_type(code="CUSTOMER_TYPE") -> Column:
    return decode(code, CUSTOMER_TYPES, CUSTOMER_TYPE_ELSE)


def _ratio(balance, limit) -> Column:
    # Only used under a "limit not 0/null" guard; try_divide keeps ANSI mode quiet.
    return F.try_divide(F.coalesce(_c(balance), F.lit(0)), _c(limit))


def credit_utilization_pct(balance="ACCOUNT_BALANCE", limit="CREDIT_LIMIT") -> Column:
    no_limit = F.coalesce(_c(limit), F.lit(0)) == 0
    return F.when(no_limit, F.lit(0)).otherwise(F.round(_ratio(balance, limit) * 100, 2))


def risk_category(balance="ACCOUNT_BALANCE", limit="CREDIT_LIMIT") -> Column:
    no_limit = F.coalesce(_c(limit), F.lit(0)) == 0
    r = _ratio(balance, limit)
    return first_match([(no_limit, RISK_NONE)] + [(r > t, label) for t, label in RISK_LEVELS],
                       RISK_ELSE)


def days_since(c, today) -> Column:
    """Day difference to today; null when never."""
    return F.when(_c(c).isNotNull(), day_diff(c, today))


def lifecycle_status(status="STATUS", last_purchase="LAST_PURCHASE_DATE", today=None) -> Column:
    s, p = _c(status), _c(last_purchase)
    cutoff = F.date_sub(today, ACTIVE_WINDOW_DAYS)
    return first_match([
        ((s == "A") & (p >= cutoff), LIFECYCLE_ACTIVE),
        ((s == "A") & (p < cutoff), LIFECYCLE_INACTIVE),
    ] + [(s == code, label) for code, label in LIFECYCLE], LIFECYCLE_ELSE)


# --- validation-result plan (V5, V6) ----------------------------------------

def load_ts_for(found: Column, last_updt="LAST_UPDT_TS", run_ts=None) -> Column:
    """V5: run time for a new id, the row's own update time for a known id."""
    return F.when(~found, run_ts).otherwise(_c(last_updt))


def strategy_flag(found: Column) -> Column:
    """V6: 0 insert, 1 update."""
    return F.when(~found, F.lit(INSERT_FLAG)).otherwise(F.lit(UPDATE_FLAG))
