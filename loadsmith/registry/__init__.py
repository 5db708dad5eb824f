"""Registered queries (Spark) and their oracle SQL (DuckDB)."""

from __future__ import annotations


def queries() -> dict:
    from loadsmith.registry.operator_queries import QUERIES as op_q
    from loadsmith.registry.plan_queries import QUERIES as plan_q
    return {**plan_q, **op_q}


def oracle_sql() -> dict:
    from loadsmith.registry.operator_oracle import ORACLE as op_o
    from loadsmith.registry.oracle import ORACLE as plan_o
    return {**plan_o, **op_o}
