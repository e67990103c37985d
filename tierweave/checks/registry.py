"""Registry of bound queries and small helpers for their SQL side."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tierweave.bindings import Tables, sql_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Fixed run date, so that results do not change from day to day.
AS_OF = "2026-01-15"


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` and its SQL equivalent."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return wrap


def bound(binding: str, name: str) -> str:
    """``name AS (binding)`` for a WITH clause."""
    return f"{name} AS ({sql_text(binding)})"


def lit(value) -> str:
    if value is None:
        return "NULL"
    return "'" + str(value).replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def case_map(expr: str, table: Mapping[str, object], default: str = "NULL") -> str:
    """CASE form of a literal lookup."""
    arms = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in table.items())
    return f"CASE {expr} {arms} ELSE {default} END"


def list_lit(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]::VARCHAR[]"


def first_hit(expr: str, table: Mapping[str, str], mode: str) -> str:
    """CASE of the first fragment found, in table order."""
    test = {"prefix": "starts_with", "contains": "contains"}[mode]
    return "CASE " + " ".join(f"WHEN {test}({expr}, {lit(k)}) THEN {lit(v)}" for k, v in table.items()) + " END"
