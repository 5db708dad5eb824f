"""Schemas of the eight inputs and five targets of the load plans.

Types follow use in the original models (money as decimal(12,2), rates as
decimal(5,4), watermarks as timestamp_ntz).  The plans select these columns in
this order and cast them to these types (``typed_source``); ``as_target`` gives a
target's columns their types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

L, S, D, TS = T.LongType(), T.StringType(), T.DateType(), T.TimestampNTZType()
MONEY, RATE, SECS, I = T.DecimalType(12, 2), T.DecimalType(5, 4), T.DecimalType(12, 3), T.IntegerType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


EMP = _struct(("EMPNO", L), ("ENAME", S), ("JOB", S), ("MGR", L), ("HIREDATE", D),
              ("SAL", MONEY), ("COMM", MONEY), ("DEPTNO", L))
DEPT = _struct(("DEPTNO", L), ("DNAME", S), ("LOC", S))
EMPLOYEES = _struct(("EMPLOYEE_ID", L), ("FIRST_NAME", S), ("LAST_NAME", S), ("EMAIL", S),
                    ("PHONE_NUMBER", S), ("HIRE_DATE", D), ("JOB_ID", S), ("SALARY", MONEY),
                    ("COMMISSION_PCT", RATE), ("MANAGER_ID", L), ("DEPARTMENT_ID", L))
CUSTOMER_MASTER = _struct(("CUSTOMER_ID", L), ("FIRST_NAME", S), ("LAST_NAME", S), ("EMAIL", S),
                          ("PHONE", S), ("ADDRESS_ID", L), ("STATUS", S),
                          ("REGISTRATION_DATE", TS), ("LAST_MODIFIED_DATE", TS))
ADDRESS_MASTER = _struct(("ADDRESS_ID", L), ("STREET", S), ("CITY", S), ("STATE", S),
                         ("ZIP_CODE", S), ("COUNTRY", S))
CUSTOMER_RAW = _struct(("CUSTOMER_ID", L), ("FIRST_NAME", S), ("LAST_NAME", S), ("EMAIL", S),
                       ("PHONE", S), ("ADDRESS", S), ("CITY", S), ("STATE", S), ("ZIP_CODE", S),
                       ("COUNTRY", S), ("CUSTOMER_TYPE", S), ("CREDIT_LIMIT", MONEY),
                       ("ACCOUNT_BALANCE", MONEY), ("REGISTRATION_DATE", TS),
                       ("LAST_PURCHASE_DATE", D), ("STATUS", S), ("CREATED_DATE", TS),
                       ("UPDATED_DATE", TS))
DIM_COUNTRY = _struct(("COUNTRY_CODE", S), ("COUNTRY_NAME", S), ("REGION", S), ("CURRENCY_CODE", S))
DATA_SRC_VAL = _struct(("DATA_SRC_VAL_ID", L), ("DATA_SRC_ID", L), ("VAL_RULE_ID", L),
                       ("VAL_EXEC_ID", L), ("VAL_EXEC_STAT_CD", S), ("VAL_EXEC_START_TS", TS),
                       ("VAL_EXEC_END_TS", TS), ("VAL_EXEC_ELAPSE_SEC", SECS),
                       ("VAL_EXEC_RESULT_TXT", S), ("VAL_EXEC_RESULT_CNT", L),
                       ("VAL_EXEC_RESULT_THRSHLD_CNT", L), ("LAST_UPDT_TS", TS),
                       ("LAST_UPDT_USER_ID", S))

# Targets, in column order (fixed names).
BONUS, PAY, PERCENT = T.DecimalType(16, 4), T.DecimalType(18, 6), T.DecimalType(18, 2)
EMP_LOAD = T.StructType([*EMP.fields, *_struct(
    ("COMM_ADJUSTED", MONEY), ("TOTAL_COMP", T.DecimalType(13, 2)), ("LOAD_DATE", TS), ("DEPT_NAME", S),
    ("DEPT_LOCATION", S)).fields])
STG_EMPLOYEE = T.StructType([*EMPLOYEES.fields, *_struct(
    ("SALARY_GRADE", S), ("COMMISSION_PCT_CLEAN", RATE), ("FULL_NAME", S), ("LOAD_TIMESTAMP", TS),
    ("HIRE_DATE_TRUNC", TS), ("DEPARTMENT_NAME", S), ("EMAIL_PREFIX", S), ("FIRST_ANNIVERSARY", D),
    ("YEARS_OF_SERVICE", L), ("IS_TOP_LEVEL", S), ("PERFORMANCE_CATEGORY", S), ("DEPARTMENT_ID_CLEAN", L),
    ("PHONE_LENGTH", L), ("EMAIL_AT_POSITION", L), ("EMAIL_UPPER", S), ("TOTAL_COMPENSATION", PAY),
    ("TENURE_BONUS", BONUS), ("DAYS_EMPLOYED", L), ("FIRST_NAME_CLEAN", S), ("LAST_NAME_CLEAN", S),
    ("PHONE_NUMBER_CLEAN", S), ("DEPARTMENT_GROUP", S), ("SALARY_RANGE", S), ("EMAIL_DOMAIN", S),
    ("HIRE_QUARTER", L), ("HIRE_YEAR", L), ("HIRE_MONTH", L), ("HIRE_DAY_OF_WEEK", L), ("EMPLOYMENT_YEARS", L),
    ("SALARY_PERCENTILE", S), ("COMMISSION_TIER", S), ("IS_MANAGER", S), ("RECORD_HASH", S),
    ("DATA_QUALITY_FLAG", S), ("EMPLOYEE_STATUS", S)).fields])
CUSTOMER_DATA_LOAD = _struct(
    ("CUSTOMER_ID", L), ("FIRST_NAME", S), ("LAST_NAME", S), ("EMAIL", S), ("PHONE", S), ("ADDRESS_ID", L),
    ("STREET", S), ("CITY", S), ("STATE", S), ("ZIP_CODE", S), ("COUNTRY", S), ("STATUS", S),
    ("REGISTRATION_DATE", TS), ("LAST_MODIFIED_DATE", TS), ("LOAD_TIMESTAMP", TS))
CUSTOMER_LOAD = _struct(
    ("CUSTOMER_ID", L), ("FIRST_NAME", S), ("LAST_NAME", S), ("FULL_NAME", S), ("EMAIL", S), ("EMAIL_DOMAIN", S),
    ("PHONE", S), ("ADDRESS", S), ("CITY", S), ("STATE", S), ("ZIP_CODE", S), ("COUNTRY_CODE", S),
    ("COUNTRY_NAME", S), ("REGION", S), ("CURRENCY_CODE", S), ("CUSTOMER_TYPE", S), ("CREDIT_LIMIT", MONEY),
    ("ACCOUNT_BALANCE", MONEY), ("CREDIT_UTILIZATION_PCT", PERCENT), ("RISK_CATEGORY", S),
    ("REGISTRATION_DATE", TS), ("LAST_PURCHASE_DATE", D), ("REGISTRATION_DATE_KEY", TS),
    ("DAYS_SINCE_LAST_PURCHASE", L), ("LIFECYCLE_STATUS", S), ("CUSTOMER_TENURE_MONTHS", L),
    ("CREATED_DATE", TS), ("UPDATED_DATE", TS), ("DW_LOAD_TIMESTAMP", TS), ("DW_RECORD_KEY", S))
VALIDATION_STAGE = T.StructType([T.StructField("DATA_SRC_VAL_STAGE_ID", S), *DATA_SRC_VAL.fields, T.StructField("LOAD_TS", TS)])

EMP_LOAD_COLS, STG_EMPLOYEE_COLS = EMP_LOAD.names, STG_EMPLOYEE.names
CUSTOMER_DATA_LOAD_COLS, CUSTOMER_LOAD_COLS = CUSTOMER_DATA_LOAD.names, CUSTOMER_LOAD.names
VALIDATION_STAGE_COLS = VALIDATION_STAGE.names


def as_target(df: DataFrame, target: T.StructType) -> DataFrame:
    """The target's columns in its order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields])


KEYS = {"customer_data_load": ["CUSTOMER_ID"], "customer_load": ["CUSTOMER_ID"],
        "validation_stage": ["DATA_SRC_VAL_STAGE_ID"]}
WATERMARKS = {"customer_data_load": "LAST_MODIFIED_DATE", "customer_load": "UPDATED_DATE",
              "validation_stage": "LAST_UPDT_TS"}
