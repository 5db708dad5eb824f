"""DuckDB oracle SQL for the operator-family queries."""

from __future__ import annotations

from loadsmith.registry.oracle import (
    CUSTOMER_TYPES, DEPARTMENT_GROUPS, DEPARTMENT_NAMES, DEPT, DIM_COUNTRY, EMP, EMPLOYEES, EVENT_CUT_TIME, GRADES,
    MASTER_STATUS, NO_EMAIL_MASTER, NO_EMAIL_RAW, PERCENTILES, RANGES, RUN_CUSTOMER, RUN_STD, RUN_VAL_1, TODAY,
    activity, after_at, banded, checked_phone, clean_or, commission_tier, customer_master, customer_raw, data_src_val,
    days_to, decoded, domain_or_default, dt, filled_or, lifecycle, months_to, performance, quality, ranged, risk, skey,
    tenure_bonus, ts, upsert_sql, utilization, val_ctes, val_rows, with_, years_to,
)

EVENT_CUT = ts(EVENT_CUT_TIME)

EVENT_CUSTOMERS = """SELECT CASE WHEN event_id % 41 = 0 THEN NULL ELSE event_id END AS CUSTOMER_ID,
  CASE WHEN user_id % 13 = 0 THEN NULL WHEN user_id % 17 = 0 THEN ' NOEMAIL@unknown.com'
       ELSE 'U' || CAST(user_id AS VARCHAR) || '@X.com ' END AS EMAIL,
  CASE WHEN event_type = 'purchase' THEN 'A' WHEN event_type = 'click' THEN 'I'
       WHEN event_type = 'view' THEN 'S' ELSE event_type END AS STATUS,
  CASE WHEN event_id % 47 = 0 THEN NULL ELSE ts END AS REGISTRATION_DATE
FROM events"""

NAMES = """SELECT c_custkey AS CUSTOMER_ID,
  CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 8 = 0 THEN '  '
       ELSE ' first' || CAST(c_custkey % 100 AS VARCHAR) || ' ' END AS FIRST_NAME,
  CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN ' '
       ELSE substring(c_name, 10, 100) END AS LAST_NAME
FROM customer"""

PAY = """SELECT l_orderkey, l_linenumber, l_extendedprice AS SAL,
  CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_extendedprice * l_discount END AS COMM,
  CASE WHEN l_linenumber = 2 THEN NULL ELSE l_discount * 3 END AS COMMISSION_PCT
FROM lineitem"""

DATED = """SELECT o_orderkey AS ORDER_ID, CAST(o_orderdate AS DATE) AS HIRE_DATE,
  o_orderdate + to_hours(CAST(o_orderkey % 24 AS BIGINT)) AS REG_TS,
  floor(o_totalprice / 10) / 2 AS SALARY,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS LAST_PURCHASE_DATE
FROM orders"""

EVENT_ROWS = "event_id, user_id, event_type, value, ts"

TD = dt(TODAY)

ORACLE = {
    "typed_scan_project": """SELECT c_custkey AS CUSTOMER_ID, c_name AS CUSTOMER_NAME,
  CAST(c_nationkey AS BIGINT) AS NATION_ID, c_acctbal AS ACCOUNT_BALANCE FROM customer""",

    "notnull_filter": with_([("emp", EMP)], "SELECT EMPNO, DEPTNO, SAL FROM emp WHERE DEPTNO IS NOT NULL"),

    "valid_row_filter": with_([("src", EVENT_CUSTOMERS)], f"""SELECT CUSTOMER_ID, lower(trim(EMAIL)) AS EMAIL,
  {decoded('STATUS', MASTER_STATUS, 'UNKNOWN')} AS STATUS, date_trunc('day', REGISTRATION_DATE) AS REGISTRATION_DATE
FROM src
WHERE CUSTOMER_ID IS NOT NULL AND REGISTRATION_DATE IS NOT NULL AND STATUS IN ('A', 'I')
  AND lower(trim(EMAIL)) <> '{NO_EMAIL_MASTER}'"""),

    "quality_flags": with_([("e", EMPLOYEES)], f"""SELECT EMPLOYEE_ID, {quality(dt(RUN_STD))} AS DATA_QUALITY_FLAG,
  {activity(dt(RUN_STD))} AS EMPLOYEE_STATUS FROM e"""),

    "quality_flag_filter": with_([("e", EMPLOYEES)], f"""SELECT EMPLOYEE_ID, SALARY, HIRE_DATE FROM e
WHERE {activity(dt(RUN_STD))} = 'ACTIVE' AND {quality(dt(RUN_STD))} = 'VALID'"""),

    "lookup_left_defaults": f"""SELECT c_custkey AS CUSTOMER_ID, coalesce(n.n_name, 'UNKNOWN') AS NATION_NAME,
  coalesce(n.n_regionkey, -1) AS REGION_KEY
FROM customer LEFT JOIN nation n
  ON CASE WHEN c_custkey % 6 = 0 THEN c_nationkey + 100 ELSE c_nationkey END = n.n_nationkey""",

    "lookup_raw_code_default": with_([("raw", customer_raw()), ("dim", DIM_COUNTRY)],
        """SELECT CUSTOMER_ID, coalesce(COUNTRY, 'US') AS COUNTRY_CODE,
  coalesce(d.COUNTRY_NAME, 'Unknown Country') AS COUNTRY_NAME,
  coalesce(d.REGION, 'Unknown Region') AS REGION, coalesce(d.CURRENCY_CODE, 'USD') AS CURRENCY_CODE
FROM raw LEFT JOIN dim d ON raw.COUNTRY = d.COUNTRY_CODE"""),

    "lookup_fanout": """SELECT c_custkey AS CUSTOMER_ID, c_nationkey % 5 AS REGION_ID,
  coalesce(n.n_name, 'UNKNOWN') AS NATION_NAME
FROM customer LEFT JOIN nation n ON c_nationkey % 5 = n.n_regionkey""",

    "existence_flag": """SELECT CUST_KEY, c_name,
  CASE WHEN CUST_KEY IN (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL)
       THEN 'Y' ELSE 'N' END AS HAS_ORDER
FROM (SELECT CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_custkey END AS CUST_KEY, c_name FROM customer) c""",

    "watermark_scan": f"""SELECT * FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts <= {EVENT_CUT})""",

    "watermark_lookback": f"""SELECT * FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts <= {EVENT_CUT}) - INTERVAL 1 HOUR""",

    "watermark_empty_target": """SELECT * FROM events
WHERE (SELECT max(ts) FROM events WHERE FALSE) IS NULL
   OR ts > (SELECT max(ts) FROM events WHERE FALSE)""",

    "watermark_first_run": with_([("v", data_src_val())], val_rows("v", None, RUN_VAL_1)),

    "keyed_upsert": with_([
        ("t", f"SELECT {EVENT_ROWS} FROM events WHERE ts <= {EVENT_CUT}"),
        ("b", f"""SELECT {EVENT_ROWS} FROM events WHERE ts > {EVENT_CUT}
UNION ALL
SELECT event_id, user_id, event_type, value + 1000 AS value, ts + to_days(20) AS ts
FROM events WHERE ts <= {EVENT_CUT} AND event_id % 10 = 0"""),
    ], upsert_sql("t", "b", "event_id")),

    "change_tag": with_(val_ctes(audit=True), "SELECT * FROM b2"),

    "latest_per_key": f"""SELECT {EVENT_ROWS} FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id, event_type, value) = 1""",

    "latest_per_key_null_order": with_([("v", f"""SELECT VAL_EXEC_ID, DATA_SRC_ID, VAL_EXEC_STAT_CD,
  CASE WHEN DATA_SRC_ID % 5 <> 0 THEN date_trunc('day', LAST_UPDT_TS) END AS LAST_UPDT_TS FROM ({data_src_val()}) x""")],
        """SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY DATA_SRC_ID
  ORDER BY LAST_UPDT_TS DESC NULLS LAST, VAL_EXEC_ID, VAL_EXEC_STAT_CD) = 1"""),

    "latest_per_key_null_key": with_([("v", f"""SELECT VAL_EXEC_ID,
  CASE WHEN VAL_EXEC_ID % 11 <> 0 THEN DATA_SRC_ID END AS DATA_SRC_ID, VAL_EXEC_STAT_CD, LAST_UPDT_TS
FROM ({data_src_val()}) x""")],
        """SELECT * FROM v WHERE DATA_SRC_ID IS NULL UNION ALL
SELECT * FROM (SELECT * FROM v WHERE DATA_SRC_ID IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY DATA_SRC_ID ORDER BY LAST_UPDT_TS DESC NULLS LAST, VAL_EXEC_ID, VAL_EXEC_STAT_CD) = 1) k"""),

    "surrogate_key": f"""SELECT event_id,
  {skey('event_id', 'user_id', 'event_type')} AS EVENT_KEY,
  {skey('CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_id END', 'ts')} AS USER_TIME_KEY
FROM events""",

    "record_hash": """SELECT c_custkey AS CUSTOMER_ID,
  md5(concat(c_custkey, if(c_custkey % 9 = 0, NULL, c_name), if(c_custkey % 4 = 0, NULL, c_nationkey),
             c_acctbal, c_mktsegment)) AS RECORD_HASH
FROM customer""",

    "name_cleaning": with_([("n", NAMES)], f"""SELECT CUSTOMER_ID,
  {clean_or('FIRST_NAME', 'UNKNOWN', 'upper')} AS MASTER_FIRST_NAME, {clean_or('LAST_NAME', 'UNKNOWN', 'upper')} AS MASTER_LAST_NAME,
  {filled_or('FIRST_NAME', 'UNKNOWN')} AS STAGED_FIRST_NAME, {filled_or('LAST_NAME', 'UNKNOWN')} AS STAGED_LAST_NAME,
  {clean_or('FIRST_NAME', '', 'upper')} || ' ' || {clean_or('LAST_NAME', '', 'upper')} AS STAGED_FULL_NAME,
  FIRST_NAME || ' ' || LAST_NAME AS FULL_NAME,
  trim(FIRST_NAME) AS FIRST_NAME_CLEAN, trim(LAST_NAME) AS LAST_NAME_CLEAN
FROM n"""),

    "email_rules": f"""WITH e AS (SELECT c_custkey AS CUSTOMER_ID,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 6 = 0 THEN 'none'
       WHEN c_custkey % 5 = 0 THEN ' X' || CAST(c_custkey AS VARCHAR) || '@Mail.Com '
       ELSE 'c' || CAST(c_custkey AS VARCHAR) || '@Ab' || CAST(c_custkey % 7 AS VARCHAR) || '.Com' END AS EMAIL
FROM customer)
SELECT CUSTOMER_ID, {clean_or('EMAIL', NO_EMAIL_MASTER)} AS MASTER_EMAIL, {clean_or('EMAIL', NO_EMAIL_RAW)} AS STAGED_EMAIL,
  {domain_or_default('EMAIL')} AS STAGED_EMAIL_DOMAIN, left(EMAIL, 10) AS EMAIL_PREFIX,
  instr(EMAIL, '@') AS EMAIL_AT_POSITION, upper(EMAIL) AS EMAIL_UPPER, {after_at('EMAIL')} AS EMAIL_DOMAIN,
  length(EMAIL) AS EMAIL_LENGTH
FROM e""",

    "phone_rules": f"""WITH p AS (SELECT o_orderkey AS ORDER_ID,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL
       WHEN o_orderkey % 9 = 0 THEN ' ' || CAST(o_orderkey % 100000 AS VARCHAR) || ' '
       ELSE '555-' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') || '-'
            || lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0') END AS PHONE
FROM orders)
SELECT ORDER_ID, {checked_phone('PHONE')} AS PHONE_CHECKED, length(PHONE) AS PHONE_LENGTH,
  regexp_replace(PHONE, '-', '', 'g') AS PHONE_NUMBER_CLEAN
FROM p""",

    "code_decode": with_([("e", f"""SELECT EMPLOYEE_ID, JOB_ID, (['R', 'W', 'C', 'Z'])[EMPLOYEE_ID % 4 + 1] AS TYPE_CODE,
  (['A', 'I', 'S', 'Q'])[EMPLOYEE_ID % 7 % 4 + 1] AS STATUS_CODE FROM ({EMPLOYEES}) x""")], f"""SELECT EMPLOYEE_ID, JOB_ID,
  {decoded('JOB_ID', DEPARTMENT_NAMES, 'Other')} AS DEPARTMENT_NAME, {decoded('JOB_ID', DEPARTMENT_GROUPS, 'ADMIN')} AS DEPARTMENT_GROUP,
  {decoded('TYPE_CODE', CUSTOMER_TYPES, 'OTHER')} AS CUSTOMER_TYPE, {decoded('STATUS_CODE', MASTER_STATUS, 'UNKNOWN')} AS STATUS
FROM e"""),

    "salary_bands": with_([("e", EMPLOYEES)], f"""SELECT EMPLOYEE_ID, SALARY, {banded('SALARY', GRADES, repr('Low'))} AS SALARY_GRADE,
  {performance('SALARY', 'COMMISSION_PCT')} AS PERFORMANCE_CATEGORY, {ranged('SALARY', RANGES, '20K+')} AS SALARY_RANGE,
  {banded('SALARY', PERCENTILES, repr('Bottom 50%'), '>=')} AS SALARY_PERCENTILE
FROM e"""),

    "commission_tier": with_([("p", PAY)], f"""SELECT l_orderkey, l_linenumber, ifnull(COMMISSION_PCT, 0) AS COMMISSION_PCT_CLEAN,
  {commission_tier('COMMISSION_PCT')} AS COMMISSION_TIER
FROM p"""),

    "compensation": with_([("p", PAY)], """SELECT l_orderkey, l_linenumber, ifnull(COMM, 0) AS COMM_ADJUSTED,
  SAL + ifnull(COMM, 0) AS TOTAL_COMP, SAL * (1 + ifnull(COMMISSION_PCT, 0)) AS TOTAL_COMPENSATION
FROM p"""),

    "credit_risk": with_([("raw", customer_raw())], f"""SELECT CUSTOMER_ID, ifnull(CREDIT_LIMIT, 0) AS CREDIT_LIMIT,
  ifnull(ACCOUNT_BALANCE, 0) AS ACCOUNT_BALANCE, {utilization('ACCOUNT_BALANCE', 'CREDIT_LIMIT')} AS CREDIT_UTILIZATION_PCT,
  {risk('ACCOUNT_BALANCE', 'CREDIT_LIMIT')} AS RISK_CATEGORY
FROM raw"""),

    "date_parts": with_([("d", DATED)], """SELECT ORDER_ID,
  date_trunc('day', HIRE_DATE) AS HIRE_DATE_TRUNC,
  date_trunc('day', REG_TS) AS REGISTRATION_DATE_KEY,
  date_part('quarter', HIRE_DATE) AS HIRE_QUARTER, date_part('year', HIRE_DATE) AS HIRE_YEAR,
  date_part('month', HIRE_DATE) AS HIRE_MONTH, date_part('dow', HIRE_DATE) AS HIRE_DAY_OF_WEEK
FROM d"""),

    "tenure": with_([("d", DATED)], f"""SELECT ORDER_ID, CAST(HIRE_DATE + INTERVAL 1 YEAR AS DATE) AS FIRST_ANNIVERSARY,
  {years_to('HIRE_DATE', TD)} AS YEARS_OF_SERVICE, {tenure_bonus('SALARY', 'HIRE_DATE', TD)} AS TENURE_BONUS,
  {days_to('HIRE_DATE', TD)} AS DAYS_EMPLOYED, CAST(floor({days_to('HIRE_DATE', TD)} / 365.25) AS BIGINT) AS EMPLOYMENT_YEARS,
  {days_to('LAST_PURCHASE_DATE', TD)} AS DAYS_SINCE_LAST_PURCHASE, {months_to('REG_TS', TD)} AS TENURE_MONTHS
FROM d"""),

    "lifecycle_status": with_([("raw", customer_raw())], f"""SELECT CUSTOMER_ID, STATUS, LAST_PURCHASE_DATE,
  {lifecycle('STATUS', 'LAST_PURCHASE_DATE', dt(RUN_CUSTOMER))} AS LIFECYCLE_STATUS
FROM raw"""),

    "null_defaults": with_([("raw", customer_raw())], """SELECT CUSTOMER_ID,
  coalesce(PHONE, 'UNKNOWN') AS PHONE, coalesce(ADDRESS, 'UNKNOWN') AS ADDRESS,
  coalesce(CITY, 'UNKNOWN') AS CITY, coalesce(STATE, 'UNKNOWN') AS STATE,
  coalesce(ZIP_CODE, '00000') AS ZIP_CODE,
  CASE WHEN (CASE WHEN CUSTOMER_ID % 10 = 0 THEN NULL ELSE CUSTOMER_ID % 100 END) IS NULL
       THEN 'Y' ELSE 'N' END AS IS_TOP_LEVEL,
  coalesce(CASE WHEN CUSTOMER_ID % 13 = 0 THEN NULL ELSE CUSTOMER_ID % 7 END, -1) AS DEPARTMENT_ID_CLEAN,
  CASE WHEN LAST_PURCHASE_DATE IS NOT NULL THEN 'BOUGHT' ELSE NULL END AS PURCHASE_MARK
FROM raw"""),

    "update_flag": with_([("m", customer_master())], """SELECT CUSTOMER_ID, REGISTRATION_DATE, LAST_MODIFIED_DATE,
  if(LAST_MODIFIED_DATE > REGISTRATION_DATE, 1, 0) AS UPDATE_FLAG FROM m"""),

    "check_not_null": with_([("emp", EMP)],
        "SELECT EMPNO, SAL, DEPTNO FROM emp WHERE SAL IS NULL OR DEPTNO IS NULL"),

    "check_unique": """SELECT CUSTOMER_KEY, count(*) AS n FROM (
  SELECT CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS CUSTOMER_KEY FROM orders) t
WHERE CUSTOMER_KEY IS NOT NULL GROUP BY CUSTOMER_KEY HAVING count(*) > 1""",

    "check_relationships": with_([("emp", EMP), ("dept", DEPT)], """SELECT EMPNO, DEPTNO FROM emp e
WHERE DEPTNO IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dept d WHERE d.DEPTNO = e.DEPTNO)"""),
}
