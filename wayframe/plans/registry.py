"""Named queries over the given tables, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wayframe.plans.proxies import twin

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}
# Operator ids of the inventory that each query exercises.
COVERS: dict[str, tuple[str, ...]] = {}
# SQL views shared by the twins, written independently of the library.
VIEWS: dict[str, str] = {}


def query(covers: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its twin when SQL can express it."""

    def register(function: Query) -> Query:
        name = function.__name__
        QUERIES[name] = function
        COVERS[name] = tuple(covers.split())
        if sql is not None:
            TWINS[name] = sql
        return function

    return register


def view(name: str, sql: str) -> None:
    VIEWS[name] = sql


def oracle(name: str) -> str:
    return twin(TWINS[name], VIEWS)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Round doubles to six digits, half to even, so summation order does not show."""
    return df.withColumns({c: F.rint(F.col(f"`{c}`") * 1e6) / 1e6 for c in columns})


def r6(expression: str) -> str:
    """The same rounding in a twin."""
    return f"(round_even(({expression}) * 1e6, 0) / 1e6)"
