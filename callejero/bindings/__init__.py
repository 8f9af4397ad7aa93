"""Queries over the benchmark tables, each with the SQL that states its result.

The benchmark tables hold no city data, so every query reads a view that shapes
a whole table into a messy feed (see ``views``); the same SELECT text defines the
view for Spark and inside the SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
MODULES = ("incidents", "scalars", "transit", "air", "places", "links", "files", "checks", "risk")


def query(oracle: str | None = None):
    """Register a function as a query under its own name, with its SQL."""

    def register(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


def load_all() -> None:
    for module in MODULES:
        import_module(f"callejero.bindings.{module}")
