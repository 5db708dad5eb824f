"""EMP load: full rebuild of the employee table with department lookup.

scan → commission/total-pay columns → drop rows without a department →
department lookup with UNKNOWN defaults → target columns → overwrite.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadsmith import schemas
from loadsmith.functions import rules
from loadsmith.functions.dates import run_timestamp
from loadsmith.operators.lookup import lookup_join
from loadsmith.sources.sinks import write_checked, write_full
from loadsmith.sources.tables import typed_source


def build(emp: DataFrame, dept: DataFrame, as_of=None, *, on_duplicate: str = "error", cast: bool = True) -> DataFrame:
    src = typed_source(emp, schemas.EMP, cast=cast)
    derived = src.select(
        "*",
        rules.comm_adjusted("COMM").alias("COMM_ADJUSTED"),
        rules.total_comp("SAL", "COMM").alias("TOTAL_COMP"),
        run_timestamp(as_of).alias("LOAD_DATE"),
    )
    kept = derived.where(F.col("DEPTNO").isNotNull())
    joined = lookup_join(kept, typed_source(dept, schemas.DEPT, cast=cast), "DEPTNO",
                         {"DEPT_NAME": ("DNAME", rules.UNKNOWN),
                          "DEPT_LOCATION": ("LOC", rules.UNKNOWN)},
                         on_duplicate=on_duplicate)
    return schemas.as_target(joined, schemas.EMP_LOAD) if cast else joined.select(*schemas.EMP_LOAD_COLS)


def load(emp: DataFrame, dept: DataFrame, table: str, as_of=None, root: str | None = None,
         not_null=(), failing=None) -> None:
    """Rebuild ``table``; with ``root``, as a new version folder (atomic repoint), and with row checks
    (``not_null`` columns, ``failing`` conditions by name) made in the same pass before it is published."""
    if not_null or failing:
        if root is None:
            raise ValueError("checks before publishing need a root for the new version")
        write_checked(build(emp, dept, as_of), table, root, not_null=not_null, failing=failing)
        return
    write_full(build(emp, dept, as_of), table, root)
