"""Customer plans on the edge rows of FIXTURES.md §3."""

import datetime as dt
from decimal import Decimal

from loadsmith import schemas
from loadsmith.plans import customer_data_load, customer_load
from tests.conftest import AS_OF

TS = dt.datetime


def _master(i, first=" ann ", last=None, email=" A@B.Com ", phone="5551234567", addr=1,
            status="A", reg=TS(2024, 1, 2, 15, 30), mod=TS(2024, 2, 1)):
    return (i, first, last, email, phone, addr, status, reg, mod)


def test_customer_master_rules(spark):
    rows = [
        _master(1),
        _master(2, first="  "),
        _master(3, phone=None), _master(4, phone=" 12345 "),
        _master(5, addr=2), _master(6, addr=None),
        _master(7, status="S"), _master(8, status="X"), _master(9, email=None),
        _master(10, email="NOEMAIL@unknown.com"), _master(None), _master(12, reg=None),
        _master(13, status="I", mod=TS(2024, 1, 2, 15, 30)),
    ]
    cm = spark.createDataFrame(rows, schemas.CUSTOMER_MASTER)
    addr = spark.createDataFrame([(1, "Main", "Town", "ST", "12345", "US")], schemas.ADDRESS_MASTER)
    out = {r.CUSTOMER_ID: r for r in customer_data_load.build(cm, addr, None, AS_OF, audit=True).collect()}
    assert set(out) == {1, 2, 3, 4, 5, 6, 13}
    r = out[1]
    assert (r.FIRST_NAME, r.LAST_NAME, r.EMAIL, r.PHONE) == ("ANN", "UNKNOWN", "a@b.com", "5551234567")
    assert (r.STREET, r.ZIP_CODE, r.STATUS) == ("Main", "12345", "ACTIVE")
    assert r.REGISTRATION_DATE == TS(2024, 1, 2)
    assert out[2].FIRST_NAME == ""
    assert (out[3].PHONE, out[4].PHONE) == ("NO-PHONE", "INVALID-PHONE")
    for k in (5, 6):
        assert (out[k].STREET, out[k].CITY, out[k].STATE, out[k].ZIP_CODE, out[k].COUNTRY) == \
            ("UNKNOWN", "UNKNOWN", "UNKNOWN", "00000", "UNKNOWN")
    assert out[1].UPDATE_FLAG == 1 and out[13].UPDATE_FLAG == 0


def _raw(i, first="x", last="y", email="X@Ab.Com", country="C1", ctype="R", limit=Decimal("1000.00"),
         bal=Decimal("100.00"), reg=TS(2023, 12, 31, 10), last_buy=dt.date(2024, 6, 1), status="A",
         upd=TS(2024, 6, 1)):
    return (i, first, last, email, "555", "addr", "city", "st", "11111", country, ctype, limit, bal,
            reg, last_buy, status, TS(2020, 1, 1), upd)


def test_customer_load_rules(spark):
    rows = [
        _raw(1, first=None, last="  "),
        _raw(2, email="none"), _raw(3, email=None),
        _raw(4, country=None),
        _raw(5, limit=None), _raw(6, limit=Decimal("0.00")),
        _raw(7, bal=Decimal("900.00")), _raw(8, bal=Decimal("901.00")),
        _raw(9, bal=Decimal("700.00")), _raw(10, bal=Decimal("701.00")),
        _raw(11, last_buy=dt.date(2024, 3, 17)), _raw(12, last_buy=dt.date(2024, 3, 16)),
        _raw(13, last_buy=None), _raw(14, ctype="Q", status="S"),
    ]
    raw = spark.createDataFrame(rows, schemas.CUSTOMER_RAW)
    dim = spark.createDataFrame([("C1", "Country One", "R1", "EUR"), ("US", "United States", "NA", "USD")],
                                schemas.DIM_COUNTRY)
    out = {r.CUSTOMER_ID: r for r in customer_load.build(raw, dim, None, AS_OF).collect()}
    assert (out[1].FIRST_NAME, out[1].LAST_NAME, out[1].FULL_NAME) == ("UNKNOWN", "UNKNOWN", " ")
    assert out[7].EMAIL_DOMAIN == "Ab.Com"
    assert out[2].EMAIL_DOMAIN == "unknown.com" and out[3].EMAIL_DOMAIN == "unknown.com"
    assert out[3].EMAIL == "no-email@unknown.com"
    assert (out[4].COUNTRY_CODE, out[4].COUNTRY_NAME, out[4].REGION, out[4].CURRENCY_CODE) == \
        ("US", "Unknown Country", "Unknown Region", "USD")
    assert out[7].COUNTRY_NAME == "Country One"
    for k in (5, 6):
        assert out[k].CREDIT_LIMIT == 0 and out[k].RISK_CATEGORY == "NO_CREDIT"
        assert out[k].CREDIT_UTILIZATION_PCT == 0
    assert [out[k].RISK_CATEGORY for k in (7, 8, 9, 10)] == \
        ["MEDIUM_RISK", "HIGH_RISK", "LOW_RISK", "MEDIUM_RISK"]
    assert float(out[8].CREDIT_UTILIZATION_PCT) == 90.1
    assert [out[k].LIFECYCLE_STATUS for k in (11, 12, 13)] == ["ACTIVE", "INACTIVE", "UNKNOWN"]
    assert out[11].DAYS_SINCE_LAST_PURCHASE == 90 and out[13].DAYS_SINCE_LAST_PURCHASE is None
    assert out[1].CUSTOMER_TENURE_MONTHS == 6
    assert out[1].REGISTRATION_DATE_KEY == TS(2023, 12, 31)
    assert (out[14].CUSTOMER_TYPE, out[14].LIFECYCLE_STATUS) == ("OTHER", "SUSPENDED")
    assert len({r.DW_RECORD_KEY for r in out.values()}) == len(out)
    assert all(len(r.DW_RECORD_KEY) == 32 for r in out.values())
