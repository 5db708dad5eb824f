"""The five load plans.  Each has ``build`` (a lazy DataFrame of the target
rows, or of the batch for incremental plans) and ``load`` (writes it)."""

from loadsmith.plans import (  # noqa: F401
    customer_data_load, customer_load, emp_load, stg_employee, validation_stage,
)
