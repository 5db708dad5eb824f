import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

AS_OF = "2024-06-15 00:00:00"


@pytest.fixture(scope="session")
def spark():
    from loadsmith.session import local_session

    warehouse = tempfile.mkdtemp(prefix="loadsmith-wh-")
    os.environ.setdefault("LOADSMITH_DRIVER_MEMORY", "4g")
    s = local_session("*", shuffle_partitions=8,
                      extra_conf={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture()
def scratch(request):
    """A fresh folder.  Tables that the test makes go at its end: names are no one's for the whole session."""
    if "spark" not in request.fixturenames:
        yield tempfile.mkdtemp(prefix="loadsmith-test-")
        return
    spark = request.getfixturevalue("spark")

    def tables():
        return {t.name for t in spark.catalog.listTables() if not t.isTemporary}

    before = tables()
    yield tempfile.mkdtemp(prefix="loadsmith-test-")
    for name in tables() - before:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def plan_text(df, mode="formatted") -> str:
    """The text ``df.explain`` prints."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()
