"""Staging employee plan on the edge rows of FIXTURES.md §3 (as_of 2024-06-15)."""

import datetime as dt
from decimal import Decimal

import pytest

from loadsmith import schemas
from loadsmith.plans import emp_load, stg_employee
from tests.conftest import AS_OF

D = dt.date


def _emp_row(i, first="Ann", last="Lee", email="x@corp.com", phone="555-123-4567",
             hired=D(2015, 1, 1), job="IT_PROG", salary=Decimal("6000.00"), comm=None, mgr=None, dept=60):
    return (i, first, last, email, phone, hired, job, salary, comm, mgr, dept)


@pytest.fixture(scope="module")
def flagged(spark):
    rows = [
        _emp_row(100, "Ann", "Lee", "ann.lee@corp.com", "555-123-4567", D(2010, 12, 31), "IT_PROG",
                 Decimal("16000.00"), Decimal("0.2500"), None, 60),
        _emp_row(101, "Bob", "Ray", "bob", "555", D(2020, 2, 29), "ST_MAN", Decimal("5000.50"), mgr=100),
        _emp_row(102, hired=D(2021, 1, 1), mgr=100),
        _emp_row(103, hired=D(2022, 6, 15), mgr=100),
        _emp_row(104, hired=D(2024, 6, 15), mgr=100),
        _emp_row(105, hired=D(2024, 6, 16), mgr=100),
        _emp_row(106, salary=None, mgr=100),
        _emp_row(107, salary=Decimal("0.00"), mgr=100),
        _emp_row(108, email=None, mgr=100),
        _emp_row(109, first=None),
        _emp_row(None, first="AB", last="C"),
        _emp_row(None, first="A", last="BC"),
    ]
    df = spark.createDataFrame(rows, schemas.EMPLOYEES)
    full = stg_employee.build(df, AS_OF, keep_invalid=True).collect()
    kept = {r["EMPLOYEE_ID"] for r in stg_employee.build(df, AS_OF).collect()}
    return {r["EMPLOYEE_ID"]: r for r in full if r["EMPLOYEE_ID"] is not None}, full, kept


def test_star_employee(flagged):
    rows, _, kept = flagged
    r = rows[100]
    assert 100 in kept
    assert (r.SALARY_GRADE, r.PERFORMANCE_CATEGORY, r.SALARY_RANGE, r.SALARY_PERCENTILE,
            r.COMMISSION_TIER, r.IS_TOP_LEVEL) == ("High", "Star Performer", "15K-20K", "Top 25%",
                                                   "Tier 2", "Y")
    assert (r.YEARS_OF_SERVICE, r.EMPLOYMENT_YEARS, r.DAYS_EMPLOYED) == (14, 13, 4915)
    assert float(r.TENURE_BONUS) == 2400.0 and float(r.TOTAL_COMPENSATION) == 20000.0
    assert (r.EMAIL_PREFIX, r.EMAIL_AT_POSITION, r.EMAIL_DOMAIN) == ("ann.lee@co", 8, "corp.com")
    assert (r.PHONE_NUMBER_CLEAN, r.PHONE_LENGTH) == ("5551234567", 12)
    assert (r.HIRE_QUARTER, r.HIRE_DAY_OF_WEEK) == (4, 5)
    assert r.FIRST_ANNIVERSARY == D(2011, 12, 31)
    assert r.HIRE_DATE_TRUNC == dt.datetime(2010, 12, 31)
    assert (r.DEPARTMENT_NAME, r.DEPARTMENT_GROUP) == ("Information Technology", "IT")
    assert r.IS_MANAGER == "Y"            # 108 (dropped later) names 100 as manager
    assert r.FULL_NAME == "Ann Lee"


def test_leap_day_and_range_gap(flagged):
    r = flagged[0][101]
    assert r.SALARY_GRADE == "Medium" and r.SALARY_RANGE == "20K+"
    assert (r.EMAIL_DOMAIN, r.EMAIL_AT_POSITION) == ("bob", 0)
    assert r.FIRST_ANNIVERSARY == D(2021, 2, 28)
    assert (r.YEARS_OF_SERVICE, r.DAYS_EMPLOYED, r.HIRE_DAY_OF_WEEK) == (4, 1568, 6)
    assert (r.DEPARTMENT_NAME, r.DEPARTMENT_GROUP) == ("Other", "OPERATIONS")


def test_tenure_bonus_boundaries(flagged):
    rows = flagged[0]
    assert rows[102].YEARS_OF_SERVICE == 3 and float(rows[102].TENURE_BONUS) == 300.0
    assert rows[103].YEARS_OF_SERVICE == 2 and float(rows[103].TENURE_BONUS) == 0.0
    assert rows[104].DAYS_EMPLOYED == 0


def test_quality_flags_and_filter(flagged):
    rows, _, kept = flagged
    assert 104 in kept
    assert (rows[105].DATA_QUALITY_FLAG, rows[105].EMPLOYEE_STATUS) == ("FUTURE_HIRE_DATE", "INACTIVE")
    assert (rows[106].DATA_QUALITY_FLAG, rows[106].EMPLOYEE_STATUS) == ("VALID", "INACTIVE")
    assert rows[107].DATA_QUALITY_FLAG == "INVALID_SALARY"
    assert rows[108].DATA_QUALITY_FLAG == "INCOMPLETE"
    assert not kept & {105, 106, 107, 108}


def test_null_semantics(flagged):
    rows, full, _ = flagged
    assert rows[109].FULL_NAME is None
    nulls = [r for r in full if r["EMPLOYEE_ID"] is None]
    assert all(r.IS_MANAGER == "N" for r in nulls)
    assert nulls[0].RECORD_HASH == nulls[1].RECORD_HASH     # no separator: (AB,C) = (A,BC)


def test_output_schema(spark, flagged):
    _, full, _ = flagged
    assert list(full[0].asDict().keys()) == schemas.STG_EMPLOYEE_COLS


def test_emp_load_edges(spark):
    emp = spark.createDataFrame([
        (1, "A", "CLERK", None, D(2020, 1, 1), Decimal("100.00"), None, 10),
        (2, "B", "CLERK", 1, D(2020, 1, 1), None, Decimal("5.00"), 10),
        (3, "C", "CLERK", 1, D(2020, 1, 1), Decimal("100.00"), Decimal("5.00"), None),
        (4, "D", "CLERK", 1, D(2020, 1, 1), Decimal("100.00"), Decimal("5.00"), 99),
    ], schemas.EMP)
    dept = spark.createDataFrame([(10, "SALES", "NYC")], schemas.DEPT)
    out = {r.EMPNO: r for r in emp_load.build(emp, dept, AS_OF).collect()}
    assert set(out) == {1, 2, 4}
    assert out[1].COMM_ADJUSTED == 0 and out[1].TOTAL_COMP == Decimal("100.00")
    assert out[2].TOTAL_COMP is None
    assert (out[4].DEPT_NAME, out[4].DEPT_LOCATION) == ("UNKNOWN", "UNKNOWN")
    assert (out[1].DEPT_NAME, out[1].DEPT_LOCATION) == ("SALES", "NYC")
    assert out[1].LOAD_DATE == dt.datetime(2024, 6, 15)
