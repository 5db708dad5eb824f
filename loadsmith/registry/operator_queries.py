"""

Each reads whole test tables (or relations Spark derives from them) and
applies one operator or one family of column rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadsmith.functions import rules
from loadsmith.functions.dates import (
    add_years, date_part, day_diff, dow_sunday0, elapsed_years, month_diff, run_date, trunc_day,
    year_diff,
)
from loadsmith.functions.keys import record_hash, surrogate_key
from loadsmith.functions.text import (
    at_position, concat_strict, email_after_at, email_domain_or, phone_check, prefix,
    remove_char, text_length,
)
from loadsmith.scratch import materialize
from loadsmith.operators.checks import (
    not_null_violations, relationship_violations, unique_violations,
)
from loadsmith.operators.lookup import existence_flag, lookup_join
from loadsmith.operators.upsert import latest_per_key, upsert_frame
from loadsmith.plans import validation_stage
from loadsmith.plans import standins as si
from loadsmith.registry import plan_queries as pq
from loadsmith.sources.tables import incremental_scan, typed_source

TODAY = "2001-08-01 00:00:00"    # literal run date for the rule queries
EVENT_CUT = "2024-01-15 00:00:00"


def _t(spark, sf, name):
    return si.table(spark, sf, name)


def _mod(c, n):
    return c % F.lit(n)


def _null_when(cond, value):
    return F.when(cond, None).otherwise(value)


# --- scans, projections, filters ------------------------------------------------

def q_typed_scan_project(spark, sf):
    schema = T.StructType([T.StructField("c_custkey", T.LongType()),
                           T.StructField("c_name", T.StringType()),
                           T.StructField("c_nationkey", T.LongType()),
                           T.StructField("c_acctbal", T.DoubleType())])
    src = typed_source(_t(spark, sf, "customer"), schema, cast=True)
    return src.select(F.col("c_custkey").alias("CUSTOMER_ID"), F.col("c_name").alias("CUSTOMER_NAME"),
                      F.col("c_nationkey").alias("NATION_ID"),
                      F.col("c_acctbal").alias("ACCOUNT_BALANCE"))


def q_notnull_filter(spark, sf):
    emp = si.emp(_t(spark, sf, "customer"))
    return emp.where(F.col("DEPTNO").isNotNull()).select("EMPNO", "DEPTNO", "SAL")


def _event_customers(events: DataFrame) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    code = (F.when(F.col("event_type") == "purchase", "A").when(F.col("event_type") == "click", "I")
            .when(F.col("event_type") == "view", "S").otherwise(F.col("event_type")))
    return events.select(
        _null_when(_mod(e, 41) == 0, e).alias("CUSTOMER_ID"),
        F.when(_mod(u, 13) == 0, None).when(_mod(u, 17) == 0, F.lit(" NOEMAIL@unknown.com"))
         .otherwise(F.concat(F.lit("U"), u.cast("string"), F.lit("@X.com "))).alias("EMAIL"),
        code.alias("STATUS"),
        _null_when(_mod(e, 47) == 0, F.col("ts")).alias("REGISTRATION_DATE"),
    )


def q_valid_row_filter(spark, sf):
    """The valid-customer filter in its pushable raw form, then the labels."""
    src = _event_customers(_t(spark, sf, "events"))
    kept = src.where(rules.master_valid_pushable())
    return kept.select("CUSTOMER_ID", rules.master_email().alias("EMAIL"),
                       rules.master_status().alias("STATUS"),
                       trunc_day("REGISTRATION_DATE").alias("REGISTRATION_DATE"))


def q_quality_flags(spark, sf):
    """Every employee row with its quality flag and status (before the filter)."""
    today = run_date(si.RUN_STD)
    return si.employees(_t(spark, sf, "orders")).select(
        "EMPLOYEE_ID", rules.data_quality_flag(today=today).alias("DATA_QUALITY_FLAG"),
        rules.employee_status(today=today).alias("EMPLOYEE_STATUS"))


def q_quality_flag_filter(spark, sf):
    """ACTIVE and VALID rows through the raw-column predicate (reaches the scan)."""
    emp = si.employees(_t(spark, sf, "orders"))
    today = run_date(si.RUN_STD)
    return emp.where(rules.active_valid_pushable(today=today)).select(
        "EMPLOYEE_ID", "SALARY", "HIRE_DATE")


# --- joins ------------------------------------------------------------------------

def q_lookup_left_defaults(spark, sf):
    cust = _t(spark, sf, "customer")
    ref = F.when(_mod(F.col("c_custkey"), 6) == 0, F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey"))
    out = lookup_join(cust.withColumn("NATION_REF", ref), _t(spark, sf, "nation"),
                      [("NATION_REF", "n_nationkey")],
                      {"NATION_NAME": ("n_name", rules.UNKNOWN), "REGION_KEY": ("n_regionkey", -1)})
    return out.select(F.col("c_custkey").alias("CUSTOMER_ID"), "NATION_NAME", "REGION_KEY")


def q_lookup_raw_code_default(spark, sf):
    raw = si.customer_raw(_t(spark, sf, "customer"), _t(spark, sf, "orders"))
    dim = si.dim_country(_t(spark, sf, "nation"), _t(spark, sf, "region"))
    out = lookup_join(raw.select("CUSTOMER_ID", "COUNTRY"), dim, [("COUNTRY", "COUNTRY_CODE")],
                      {n: (n, d) for n, d in rules.COUNTRY_DEFAULTS})
    return out.select("CUSTOMER_ID",
                      F.coalesce(F.col("COUNTRY"), F.lit(rules.COUNTRY_CODE_DEFAULT)).alias("COUNTRY_CODE"),
                      "COUNTRY_NAME", "REGION", "CURRENCY_CODE")


def q_lookup_fanout(spark, sf):
    """Lookup on a non-unique key with SQL semantics kept (one row per match)."""
    cust = _t(spark, sf, "customer").select("c_custkey", (F.col("c_nationkey") % 5).alias("REGION_ID"))
    out = lookup_join(cust, _t(spark, sf, "nation"), [("REGION_ID", "n_regionkey")],
                      {"NATION_NAME": ("n_name", rules.UNKNOWN)}, on_duplicate="fanout")
    return out.select(F.col("c_custkey").alias("CUSTOMER_ID"), "REGION_ID", "NATION_NAME")


def q_existence_flag(spark, sf):
    cust = _t(spark, sf, "customer").select(
        _null_when(_mod(F.col("c_custkey"), 50) == 0, F.col("c_custkey")).alias("CUST_KEY"),
        F.col("c_name"))
    return existence_flag(cust, "CUST_KEY", _t(spark, sf, "orders"), "o_custkey", name="HAS_ORDER")


# --- incremental scan, upsert, change tag -------------------------------------------

def _events_cut(spark, sf):
    return _t(spark, sf, "events").where(F.col("ts") <= F.lit(EVENT_CUT).cast("timestamp_ntz"))


def q_watermark_scan(spark, sf):
    return incremental_scan(_t(spark, sf, "events"), _events_cut(spark, sf), "ts")


def q_watermark_lookback(spark, sf):
    return incremental_scan(_t(spark, sf, "events"), _events_cut(spark, sf), "ts", lookback="1 HOUR")


def q_watermark_empty_target(spark, sf):
    empty = _t(spark, sf, "events").where(F.lit(False))
    return incremental_scan(_t(spark, sf, "events"), empty, "ts")


def q_watermark_first_run(spark, sf):
    src = si.data_src_val(_t(spark, sf, "events"))
    return validation_stage.build(src, None, si.RUN_VAL_1, cast=False)


def _event_rows(df):
    return df.select("event_id", "user_id", "event_type", "value", "ts")


def q_keyed_upsert(spark, sf):
    events = _t(spark, sf, "events")
    cut = F.lit(EVENT_CUT).cast("timestamp_ntz")
    target = _event_rows(events.where(F.col("ts") <= cut))
    changed = events.where((F.col("ts") <= cut) & (_mod(F.col("event_id"), 10) == 0)).select(
        "event_id", "user_id", "event_type", (F.col("value") + 1000).alias("value"),
        (F.col("ts") + F.make_dt_interval(F.lit(20))).alias("ts"))
    batch = _event_rows(events.where(F.col("ts") > cut)).unionByName(changed)
    return upsert_frame(target, batch, "event_id")


def q_change_tag(spark, sf):
    target = materialize(pq.val_first_run(spark, sf), "target")
    return pq.val_second_batch(spark, sf, target, audit=True)


def q_latest_per_key(spark, sf):
    return latest_per_key(_event_rows(_t(spark, sf, "events")), "user_id", "ts")


def _val_rows(spark, sf):
    rows = si.data_src_val(_t(spark, sf, "events"))
    return rows.select("VAL_EXEC_ID", "DATA_SRC_ID", "VAL_EXEC_STAT_CD", "LAST_UPDT_TS")


def q_latest_per_key_null_order(spark, sf):
    """Times are null for some rows, and for every row of some sources; ties go by the other columns."""
    unknown = (_mod(F.col("DATA_SRC_ID"), 5) == 0) | F.col("LAST_UPDT_TS").isNull()
    rows = _val_rows(spark, sf).withColumn("LAST_UPDT_TS", _null_when(unknown, F.date_trunc("day", "LAST_UPDT_TS").cast("timestamp_ntz")))
    return latest_per_key(rows, "DATA_SRC_ID", "LAST_UPDT_TS")


def q_latest_per_key_null_key(spark, sf):
    """Rows without a key are all kept."""
    rows = _val_rows(spark, sf).withColumn("DATA_SRC_ID", _null_when(_mod(F.col("VAL_EXEC_ID"), 11) == 0, F.col("DATA_SRC_ID")))
    return latest_per_key(rows, "DATA_SRC_ID", "LAST_UPDT_TS")


# --- keys ----------------------------------------------------------------------------

def q_surrogate_key(spark, sf):
    ev = _t(spark, sf, "events")
    u = _null_when(_mod(F.col("user_id"), 7) == 0, F.col("user_id"))
    return ev.select("event_id",
                     surrogate_key("event_id", "user_id", "event_type").alias("EVENT_KEY"),
                     surrogate_key(u, "ts").alias("USER_TIME_KEY"))


def q_record_hash(spark, sf):
    c = _t(spark, sf, "customer")
    k = F.col("c_custkey")
    name = _null_when(_mod(k, 9) == 0, F.col("c_name"))
    nation = _null_when(_mod(k, 4) == 0, F.col("c_nationkey"))
    return c.select(k.alias("CUSTOMER_ID"),
                    record_hash(k, name, nation, "c_acctbal", "c_mktsegment").alias("RECORD_HASH"))


# --- column rule families --------------------------------------------------------------

def _names(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    first = (F.when(_mod(k, 9) == 0, None).when(_mod(k, 8) == 0, F.lit("  "))
             .otherwise(F.concat(F.lit(" first"), _mod(k, 100).cast("string"), F.lit(" "))))
    last = (F.when(_mod(k, 10) == 0, None).when(_mod(k, 7) == 0, F.lit(" "))
            .otherwise(F.col("c_name").substr(10, 100)))
    return customer.select(k.alias("CUSTOMER_ID"), first.alias("FIRST_NAME"), last.alias("LAST_NAME"))


def q_name_cleaning(spark, sf):
    n = _names(_t(spark, sf, "customer"))
    return n.select(
        "CUSTOMER_ID",
        rules.master_name("FIRST_NAME").alias("MASTER_FIRST_NAME"),
        rules.master_name("LAST_NAME").alias("MASTER_LAST_NAME"),
        rules.staged_name("FIRST_NAME").alias("STAGED_FIRST_NAME"),
        rules.staged_name("LAST_NAME").alias("STAGED_LAST_NAME"),
        rules.staged_full_name().alias("STAGED_FULL_NAME"),
        concat_strict("FIRST_NAME", F.lit(" "), "LAST_NAME").alias("FULL_NAME"),
        F.trim("FIRST_NAME").alias("FIRST_NAME_CLEAN"),
        F.trim("LAST_NAME").alias("LAST_NAME_CLEAN"),
    )


def q_email_rules(spark, sf):
    c = _t(spark, sf, "customer")
    k = F.col("c_custkey")
    email = (F.when(_mod(k, 11) == 0, None).when(_mod(k, 6) == 0, F.lit("none"))
             .when(_mod(k, 5) == 0, F.concat(F.lit(" X"), k.cast("string"), F.lit("@Mail.Com ")))
             .otherwise(F.concat(F.lit("c"), k.cast("string"), F.lit("@Ab"), _mod(k, 7).cast("string"),
                                 F.lit(".Com"))))
    e = c.select(k.alias("CUSTOMER_ID"), email.alias("EMAIL"))
    return e.select(
        "CUSTOMER_ID",
        rules.master_email().alias("MASTER_EMAIL"),
        rules.staged_email().alias("STAGED_EMAIL"),
        email_domain_or("EMAIL", rules.EMAIL_DOMAIN_DEFAULT).alias("STAGED_EMAIL_DOMAIN"),
        prefix("EMAIL", rules.EMAIL_PREFIX_LEN).alias("EMAIL_PREFIX"),
        at_position("EMAIL").alias("EMAIL_AT_POSITION"),
        F.upper("EMAIL").alias("EMAIL_UPPER"),
        email_after_at("EMAIL").alias("EMAIL_DOMAIN"),
        text_length("EMAIL").alias("EMAIL_LENGTH"),
    )


def q_phone_rules(spark, sf):
    o = _t(spark, sf, "orders")
    k = F.col("o_orderkey")
    phone = (F.when(_mod(k, 11) == 0, None)
             .when(_mod(k, 9) == 0, F.concat(F.lit(" "), _mod(k, 100000).cast("string"), F.lit(" ")))
             .otherwise(F.concat(F.lit("555-"), F.lpad(_mod(k, 1000).cast("string"), 3, "0"), F.lit("-"),
                                 F.lpad(_mod(k, 10000).cast("string"), 4, "0"))))
    p = o.select(k.alias("ORDER_ID"), phone.alias("PHONE"))
    return p.select(
        "ORDER_ID",
        phone_check("PHONE", rules.NO_PHONE, rules.BAD_PHONE, rules.PHONE_MIN_LEN).alias("PHONE_CHECKED"),
        text_length("PHONE").alias("PHONE_LENGTH"),
        remove_char("PHONE", "-").alias("PHONE_NUMBER_CLEAN"),
    )


def q_code_decode(spark, sf):
    emp = si.employees(_t(spark, sf, "orders"))
    k = F.col("EMPLOYEE_ID")
    type_code = F.element_at(F.array(*[F.lit(x) for x in ["R", "W", "C", "Z"]]), (_mod(k, 4) + 1).cast("int"))
    status_code = F.element_at(F.array(*[F.lit(x) for x in ["A", "I", "S", "Q"]]),
                               (_mod(k, 7) % 4 + 1).cast("int"))
    return emp.select(
        "EMPLOYEE_ID", "JOB_ID",
        rules.department_name().alias("DEPARTMENT_NAME"),
        rules.department_group().alias("DEPARTMENT_GROUP"),
        rules.customer_type(type_code).alias("CUSTOMER_TYPE"),
        rules.master_status(status_code).alias("STATUS"),
    )


def q_salary_bands(spark, sf):
    emp = si.employees(_t(spark, sf, "orders"))
    return emp.select(
        "EMPLOYEE_ID", "SALARY",
        rules.salary_grade().alias("SALARY_GRADE"),
        rules.performance_category().alias("PERFORMANCE_CATEGORY"),
        rules.salary_range().alias("SALARY_RANGE"),
        rules.salary_percentile().alias("SALARY_PERCENTILE"),
    )


def _lineitem_pay(spark, sf):
    li = _t(spark, sf, "lineitem")
    n = F.col("l_linenumber")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.col("l_extendedprice").alias("SAL"),
        _null_when(_mod(n, 3) == 0, F.col("l_extendedprice") * F.col("l_discount")).alias("COMM"),
        _null_when(n == 2, F.col("l_discount") * 3).alias("COMMISSION_PCT"),
    )


def q_commission_tier(spark, sf):
    pay = _lineitem_pay(spark, sf)
    return pay.select("l_orderkey", "l_linenumber",
                      F.coalesce(F.col("COMMISSION_PCT"), F.lit(0)).alias("COMMISSION_PCT_CLEAN"),
                      rules.commission_tier().alias("COMMISSION_TIER"))


def q_compensation(spark, sf):
    pay = _lineitem_pay(spark, sf)
    return pay.select("l_orderkey", "l_linenumber",
                      rules.comm_adjusted().alias("COMM_ADJUSTED"),
                      rules.total_comp().alias("TOTAL_COMP"),
                      rules.total_compensation("SAL", "COMMISSION_PCT").alias("TOTAL_COMPENSATION"))


def q_credit_risk(spark, sf):
    raw = si.customer_raw(_t(spark, sf, "customer"), _t(spark, sf, "orders"))
    return raw.select(
        "CUSTOMER_ID",
        F.coalesce(F.col("CREDIT_LIMIT"), F.lit(0)).alias("CREDIT_LIMIT"),
        F.coalesce(F.col("ACCOUNT_BALANCE"), F.lit(0)).alias("ACCOUNT_BALANCE"),
        rules.credit_utilization_pct().alias("CREDIT_UTILIZATION_PCT"),
        rules.risk_category().alias("RISK_CATEGORY"),
    )


def _dated_orders(spark, sf):
    o = _t(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("ORDER_ID"),
        F.col("o_orderdate").cast("date").alias("HIRE_DATE"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), _mod(k, 24).cast("int"))).alias("REG_TS"),
        (F.floor(F.col("o_totalprice") / 10).cast("double") / 2).alias("SALARY"),
        _null_when(_mod(k, 5) == 0, F.col("o_orderdate").cast("date")).alias("LAST_PURCHASE_DATE"),
    )


def q_date_parts(spark, sf):
    d = _dated_orders(spark, sf)
    return d.select(
        "ORDER_ID",
        trunc_day("HIRE_DATE").alias("HIRE_DATE_TRUNC"),
        trunc_day("REG_TS").alias("REGISTRATION_DATE_KEY"),
        date_part("quarter", "HIRE_DATE").alias("HIRE_QUARTER"),
        date_part("year", "HIRE_DATE").alias("HIRE_YEAR"),
        date_part("month", "HIRE_DATE").alias("HIRE_MONTH"),
        dow_sunday0("HIRE_DATE").alias("HIRE_DAY_OF_WEEK"),
    )


def q_tenure(spark, sf):
    d = _dated_orders(spark, sf)
    today = run_date(TODAY)
    days = day_diff("HIRE_DATE", today)
    return d.select(
        "ORDER_ID",
        add_years("HIRE_DATE", 1).alias("FIRST_ANNIVERSARY"),
        year_diff("HIRE_DATE", today).alias("YEARS_OF_SERVICE"),
        rules.tenure_bonus(today=today).alias("TENURE_BONUS"),
        days.alias("DAYS_EMPLOYED"),
        elapsed_years(days).alias("EMPLOYMENT_YEARS"),
        rules.days_since("LAST_PURCHASE_DATE", today).alias("DAYS_SINCE_LAST_PURCHASE"),
        month_diff("REG_TS", today).alias("TENURE_MONTHS"),
    )


def q_lifecycle_status(spark, sf):
    raw = si.customer_raw(_t(spark, sf, "customer"), _t(spark, sf, "orders"))
    today = run_date(si.RUN_CUSTOMER)
    return raw.select("CUSTOMER_ID", "STATUS", "LAST_PURCHASE_DATE",
                      rules.lifecycle_status(today=today).alias("LIFECYCLE_STATUS"))


def q_null_defaults(spark, sf):
    raw = si.customer_raw(_t(spark, sf, "customer"), _t(spark, sf, "orders"))
    k = F.col("CUSTOMER_ID")
    mgr = _null_when(_mod(k, 10) == 0, _mod(k, 100))
    dept = _null_when(_mod(k, 13) == 0, _mod(k, 7))
    return raw.select(
        "CUSTOMER_ID",
        *[F.coalesce(F.col(c), F.lit(d)).alias(c) for c, d in rules.CONTACT_DEFAULTS],
        rules.is_top_level(mgr).alias("IS_TOP_LEVEL"),
        rules.department_id_clean(dept).alias("DEPARTMENT_ID_CLEAN"),
        F.when(F.col("LAST_PURCHASE_DATE").isNotNull(), F.lit("BOUGHT")).alias("PURCHASE_MARK"),
    )


def q_update_flag(spark, sf):
    src = si.customer_master(_t(spark, sf, "orders"))
    return src.select("CUSTOMER_ID", "REGISTRATION_DATE", "LAST_MODIFIED_DATE", rules.update_flag().alias("UPDATE_FLAG"))


# --- data checks ------------------------------------------------------------------------

def q_check_not_null(spark, sf):
    emp = si.emp(_t(spark, sf, "customer")).select("EMPNO", "SAL", "DEPTNO")
    return not_null_violations(emp, ["SAL", "DEPTNO"])


def q_check_unique(spark, sf):
    o = _t(spark, sf, "orders")
    key = _null_when(_mod(F.col("o_orderkey"), 5) == 0, F.col("o_custkey")).alias("CUSTOMER_KEY")
    return unique_violations(o.select(key), "CUSTOMER_KEY")


def q_check_relationships(spark, sf):
    emp = si.emp(_t(spark, sf, "customer")).select("EMPNO", "DEPTNO")
    return relationship_violations(emp, "DEPTNO", si.dept(_t(spark, sf, "nation")))


QUERIES = {
    "typed_scan_project": q_typed_scan_project,
    "notnull_filter": q_notnull_filter,
    "valid_row_filter": q_valid_row_filter,
    "quality_flags": q_quality_flags,
    "quality_flag_filter": q_quality_flag_filter,
    "lookup_left_defaults": q_lookup_left_defaults,
    "lookup_raw_code_default": q_lookup_raw_code_default,
    "lookup_fanout": q_lookup_fanout,
    "existence_flag": q_existence_flag,
    "watermark_scan": q_watermark_scan,
    "watermark_lookback": q_watermark_lookback,
    "watermark_empty_target": q_watermark_empty_target,
    "watermark_first_run": q_watermark_first_run,
    "keyed_upsert": q_keyed_upsert,
    "change_tag": q_change_tag,
    "latest_per_key": q_latest_per_key,
    "latest_per_key_null_order": q_latest_per_key_null_order,
    "latest_per_key_null_key": q_latest_per_key_null_key,
    "surrogate_key": q_surrogate_key,
    "record_hash": q_record_hash,
    "name_cleaning": q_name_cleaning,
    "email_rules": q_email_rules,
    "phone_rules": q_phone_rules,
    "code_decode": q_code_decode,
    "salary_bands": q_salary_bands,
    "commission_tier": q_commission_tier,
    "compensation": q_compensation,
    "credit_risk": q_credit_risk,
    "date_parts": q_date_parts,
    "tenure": q_tenure,
    "lifecycle_status": q_lifecycle_status,
    "null_defaults": q_null_defaults,
    "update_flag": q_update_flag,
    "check_not_null": q_check_not_null,
    "check_unique": q_check_unique,
    "check_relationships": q_check_relationships,
}
