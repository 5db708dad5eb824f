"""Inputs of the reference shape derived from the driver's test tables.

The plans expect the reference sources (employees, customer master, ...).
These functions derive them from the TPC-H-like tables with deterministic
column expressions, including nulls, blanks and edge values made from the
keys, so each plan runs over whole tables and its work grows with them.  The
oracle SQL in ``loadsmith.registry.oracle`` derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadsmith.operators.lookup import lookup_join

# Fixed values of the stand-ins (shared with the oracle SQL).
JOB_CODES = ["IT_PROG", "IT_SUPPORT", "SA_REP", "SA_MAN", "FI_ACCOUNT", "FI_MGR",
             "ST_CLERK", "ST_MAN", "AD_PRES"]
CREDIT_LIMITS = [None, 0.0, 3000.0, 7000.0, 11000.0, 13000.0]
RAW_STATUS = ["A", "A", "S", "C", "X"]
MISSING_OFFSET = 100_000_000            # added to some references so their lookup misses
RUN_STD = "2000-06-15 00:00:00"       # staging plan run clock
RUN_EMP = "2024-06-15 00:00:00"
RUN_CUSTOMER_1, RUN_CUSTOMER = "2001-01-20 12:00:00", "2001-08-01 00:00:00"
RUN_MASTER_1, RUN_MASTER_2 = "1999-01-01 00:00:00", "2001-09-01 00:00:00"
MASTER_CUT = "1999-01-01 00:00:00"
RUN_VAL_1, RUN_VAL_2 = "2024-01-15 12:00:00", "2024-02-01 00:00:00"
VAL_CUT = "2024-01-15 00:00:00"
CUSTOMER_CUT = "2001-01-20 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table.  Each is one file with one row group, read by one task; a session may
    name the read parallelism it wants in ``loadsmith.read.partitions`` (the bench does)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    parts = spark.conf.get("loadsmith.read.partitions", None)
    return df.repartition(int(parts)) if parts else df


def _k(name: str) -> Column:
    return F.col(name)


def _mod(c: Column, n: int) -> Column:
    return c % F.lit(n)


def _s(c: Column) -> Column:
    return c.cast("string")


def _hours(c: Column) -> Column:
    return F.make_dt_interval(F.lit(0), c.cast("int"))


def _days(c: Column) -> Column:
    return F.make_dt_interval(c.cast("int"))


def _secs(c: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), c.cast("decimal(18,6)"))


def emp(customer: DataFrame) -> DataFrame:
    k = _k("c_custkey")
    return customer.select(
        k.alias("EMPNO"), F.col("c_name").alias("ENAME"), F.col("c_mktsegment").alias("JOB"),
        F.when(_mod(k, 10) == 0, None).otherwise(_mod(k, 100)).alias("MGR"),
        F.date_add(F.lit("1990-01-01").cast("date"), _mod(k, 9000).cast("int")).alias("HIREDATE"),
        F.when(_mod(k, 11) == 0, None).otherwise(F.col("c_acctbal")).alias("SAL"),
        F.when(_mod(k, 3) == 0, None).otherwise(_mod(k, 500).cast("double")).alias("COMM"),
        F.when(_mod(k, 13) == 0, None)
         .when(_mod(k, 17) == 0, F.col("c_nationkey").cast("long") + MISSING_OFFSET)
         .otherwise(F.col("c_nationkey").cast("long")).alias("DEPTNO"),
    )


def dept(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_nationkey").cast("long").alias("DEPTNO"), F.col("n_name").alias("DNAME"),
        F.concat(F.lit("REGION_"), _s(F.col("n_regionkey"))).alias("LOC"))


def employees(orders: DataFrame) -> DataFrame:
    k = _k("o_orderkey")
    jobs = F.array(*[F.lit(j) for j in JOB_CODES])
    return orders.select(
        k.alias("EMPLOYEE_ID"),
        F.when(_mod(k, 17) == 0, None).when(_mod(k, 5) == 0, F.lit("  "))
         .otherwise(F.concat(F.lit(" Emp"), F.col("o_orderstatus"), F.lit(" "))).alias("FIRST_NAME"),
        F.concat(F.lit("L"), _s(F.col("o_custkey"))).alias("LAST_NAME"),
        F.when(_mod(k, 19) == 0, None).when(_mod(k, 4) == 0, F.concat(F.lit("user"), _s(k)))
         .otherwise(F.concat(F.lit("user"), _s(k), F.lit("@corp"), _s(_mod(F.col("o_custkey"), 10)),
                             F.lit(".com"))).alias("EMAIL"),
        F.when(_mod(k, 23) == 0, None)
         .otherwise(F.concat(F.lit("555-"), _s(_mod(F.col("o_custkey"), 1000)), F.lit("-"),
                             _s(_mod(k, 10000)))).alias("PHONE_NUMBER"),
        F.when(_mod(k, 29) == 0, None).otherwise(F.col("o_orderdate").cast("date")).alias("HIRE_DATE"),
        F.element_at(jobs, (_mod(k, len(JOB_CODES)) + 1).cast("int")).alias("JOB_ID"),
        F.when(_mod(k, 31) == 0, None).when(_mod(k, 37) == 0, F.lit(0.0))
         .otherwise(F.floor(F.col("o_totalprice") / 10).cast("double") / 2).alias("SALARY"),
        F.when(_mod(k, 3) == 0, None).otherwise(_mod(k, 40).cast("double") / 100.0)
         .alias("COMMISSION_PCT"),
        F.when(_mod(k, 11) == 0, None).otherwise(F.col("o_custkey")).alias("MANAGER_ID"),
        F.when(_mod(k, 13) == 0, None).otherwise(_mod(F.col("o_custkey"), 10)).alias("DEPARTMENT_ID"),
    )


def customer_master(orders: DataFrame, modified_before: str | None = None) -> DataFrame:
    """Customer master rows from orders.  With ``modified_before``, every tenth
    row up to that time is modified 1000 days later, and one in thirty of them
    is suspended at the same time (so it leaves the valid rows)."""
    k = _k("o_orderkey")
    reg = F.col("o_orderdate") + _hours(_mod(k, 24))
    modified = F.col("o_orderdate") + _hours(_mod(k, 24)) + _days(_mod(k, 3))
    status = (F.when(F.col("o_orderstatus") == "F", "A").when(F.col("o_orderstatus") == "O", "I")
              .otherwise("S"))
    if modified_before is not None:
        hit = (_mod(k, 10) == 1) & (modified <= F.lit(modified_before).cast("timestamp_ntz"))
        status = F.when(hit & (_mod(k, 30) == 1), F.lit("S")).otherwise(status)
        modified = F.when(hit, modified + _days(F.lit(1000))).otherwise(modified)
    return orders.select(
        F.when(_mod(k, 41) == 0, None).otherwise(k).alias("CUSTOMER_ID"),
        F.when(_mod(k, 17) == 0, None).when(_mod(k, 7) == 0, F.lit("  "))
         .otherwise(F.concat(F.lit(" cust"), F.col("o_orderstatus"), F.lit(" "))).alias("FIRST_NAME"),
        F.when(_mod(k, 13) == 0, None).otherwise(F.concat(F.lit("Last"), _s(F.col("o_custkey"))))
         .alias("LAST_NAME"),
        F.when(_mod(k, 19) == 0, None).when(_mod(k, 23) == 0, F.lit(" NOEMAIL@unknown.com "))
         .otherwise(F.concat(F.lit(" User"), _s(k), F.lit("@Mail.Com "))).alias("EMAIL"),
        F.when(_mod(k, 11) == 0, None)
         .when(_mod(k, 9) == 0, F.concat(F.lit(" "), _s(_mod(k, 100000)), F.lit(" ")))
         .otherwise(F.concat(F.lit(" 555"), F.lpad(_s(_mod(k, 10000000)), 7, "0"), F.lit(" ")))
         .alias("PHONE"),
        F.when(_mod(k, 7) == 0, None).when(_mod(k, 10) == 0, F.col("o_custkey") + MISSING_OFFSET)
         .otherwise(F.col("o_custkey")).alias("ADDRESS_ID"),
        F.when(_mod(k, 43) == 0, F.lit("X")).otherwise(status).alias("STATUS"),
        F.when(_mod(k, 47) == 0, None).otherwise(reg).alias("REGISTRATION_DATE"),
        modified.alias("LAST_MODIFIED_DATE"),
    )


def address_master(customer: DataFrame) -> DataFrame:
    k = _k("c_custkey")
    return customer.select(
        k.alias("ADDRESS_ID"), F.col("c_name").alias("STREET"),
        F.concat(F.lit("CITY_"), _s(F.col("c_nationkey"))).alias("CITY"),
        F.col("c_mktsegment").alias("STATE"),
        F.lpad(_s(_mod(k, 100000)), 5, "0").alias("ZIP_CODE"),
        F.concat(F.lit("NATION_"), _s(F.col("c_nationkey"))).alias("COUNTRY"),
    )


def customer_raw(customer: DataFrame, orders: DataFrame, modified_before: str | None = None
                 ) -> DataFrame:
    """One row per customer; LAST_PURCHASE_DATE is the customer's latest order date.
    With ``modified_before``, customers with key % 10 = 3 updated up to that
    time are updated again 2000 hours later."""
    last = (orders.groupBy("o_custkey")
            .agg(F.max("o_orderdate").cast("date").alias("__last")))
    k = _k("c_custkey")
    limits = F.element_at(F.array(*[F.lit(v).cast("double") for v in CREDIT_LIMITS]),
                          (_mod(k, len(CREDIT_LIMITS)) + 1).cast("int"))
    base = F.lit("1990-01-01 00:00:00").cast("timestamp_ntz")
    updated = F.lit("2001-01-01 00:00:00").cast("timestamp_ntz") + _hours(k)
    if modified_before is not None:
        hit = (_mod(k, 10) == 3) & (updated <= F.lit(modified_before).cast("timestamp_ntz"))
        updated = F.when(hit, updated + _hours(F.lit(2000))).otherwise(updated)
    joined = customer.join(last, k == F.col("o_custkey"), "left")
    return joined.select(
        k.alias("CUSTOMER_ID"),
        F.when(_mod(k, 9) == 0, None).when(_mod(k, 8) == 0, F.lit("  "))
         .otherwise(F.concat(F.lit(" first"), _s(_mod(k, 100)), F.lit(" "))).alias("FIRST_NAME"),
        F.when(_mod(k, 10) == 0, None).when(_mod(k, 7) == 0, F.lit(" "))
         .otherwise(F.col("c_name").substr(10, 100)).alias("LAST_NAME"),
        F.when(_mod(k, 11) == 0, None).when(_mod(k, 6) == 0, F.lit("none"))
         .otherwise(F.concat(F.lit(" C"), _s(k), F.lit("@Mail"), _s(_mod(k, 5)), F.lit(".Com")))
         .alias("EMAIL"),
        F.when(_mod(k, 12) == 0, None).otherwise(F.concat(F.lit("555-"), _s(k))).alias("PHONE"),
        F.when(_mod(k, 13) == 0, None).otherwise(F.concat(_s(k), F.lit(" Main St"))).alias("ADDRESS"),
        F.when(_mod(k, 14) == 0, None).otherwise(F.concat(F.lit("City"), _s(F.col("c_nationkey"))))
         .alias("CITY"),
        F.when(_mod(k, 15) == 0, None).otherwise(F.col("c_mktsegment")).alias("STATE"),
        F.when(_mod(k, 16) == 0, None).otherwise(F.lpad(_s(_mod(k, 100000)), 5, "0")).alias("ZIP_CODE"),
        F.when(_mod(k, 17) == 0, None)
         .when(_mod(k, 23) == 0, F.concat(F.lit("X"), _s(F.col("c_nationkey"))))
         .otherwise(F.concat(F.lit("C"), _s(F.col("c_nationkey")))).alias("COUNTRY"),
        F.when(F.col("c_mktsegment") == "BUILDING", "R").when(F.col("c_mktsegment") == "MACHINERY", "W")
         .when(F.col("c_mktsegment") == "AUTOMOBILE", "C").otherwise("H").alias("CUSTOMER_TYPE"),
        limits.alias("CREDIT_LIMIT"),
        F.when(_mod(k, 19) == 0, None).otherwise(F.floor(F.abs(F.col("c_acctbal"))).cast("double"))
         .alias("ACCOUNT_BALANCE"),
        F.when(_mod(k, 20) == 0, None).otherwise(base + _days(_mod(k, 5000)) + _hours(_mod(k, 24)))
         .alias("REGISTRATION_DATE"),
        F.when(_mod(k, 21) == 0, None).otherwise(F.col("__last")).alias("LAST_PURCHASE_DATE"),
        F.element_at(F.array(*[F.lit(s) for s in RAW_STATUS]),
                     (_mod(k, len(RAW_STATUS)) + 1).cast("int")).alias("STATUS"),
        (base + _days(_mod(k, 5000))).alias("CREATED_DATE"),
        updated.alias("UPDATED_DATE"),
    )


def dim_country(nation: DataFrame, region: DataFrame) -> DataFrame:
    named = lookup_join(nation, region, [("n_regionkey", "r_regionkey")], {"REGION": ("r_name", None)})
    return named.select(
        F.concat(F.lit("C"), _s(F.col("n_nationkey"))).alias("COUNTRY_CODE"),
        F.col("n_name").alias("COUNTRY_NAME"), "REGION",
        F.concat(F.lit("CUR"), _s(F.col("n_regionkey"))).alias("CURRENCY_CODE"),
    )


def data_src_val(events: DataFrame, modified_before: str | None = None) -> DataFrame:
    """Validation results from events.  Result ids pair up events (id // 2),
    so one id can hold two keys.  With ``modified_before``, every tenth
    event up to that time is re-issued 20 days later (a changed result)."""
    e = _k("event_id")
    ts = F.col("ts")
    if modified_before is not None:
        cut = F.lit(modified_before).cast("timestamp_ntz")
        ts = F.when((_mod(e, 10) == 0) & (ts <= cut), ts + _days(F.lit(20))).otherwise(ts)
    return events.select(
        F.floor(e / 2).alias("DATA_SRC_VAL_ID"), F.col("user_id").alias("DATA_SRC_ID"),
        _mod(e, 2).alias("VAL_RULE_ID"), e.alias("VAL_EXEC_ID"),
        F.col("event_type").alias("VAL_EXEC_STAT_CD"), F.col("ts").alias("VAL_EXEC_START_TS"),
        (F.col("ts") + _secs(_mod(e, 600))).alias("VAL_EXEC_END_TS"),
        F.col("value").alias("VAL_EXEC_ELAPSE_SEC"), F.col("props").alias("VAL_EXEC_RESULT_TXT"),
        F.col("user_id").alias("VAL_EXEC_RESULT_CNT"), _mod(e, 100).alias("VAL_EXEC_RESULT_THRSHLD_CNT"),
        F.when(_mod(e, 97) == 0, None).otherwise(ts).alias("LAST_UPDT_TS"),
        F.concat(F.lit("user_"), _s(F.col("user_id"))).alias("LAST_UPDT_USER_ID"),
    )
