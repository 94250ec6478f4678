"""Queries over the test tables, each with independent SQL to compare with."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import settle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
MODULES = ("tables", "changes", "flows", "streams", "maintained")


def query(sql: str | None = None, name: str | None = None):
    """Registers a query under its function's name, with its SQL if there is any."""

    def register(fn):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} exists")
        QUERIES[key] = lambda spark, sf: fn(settle(spark), sf)
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return register


def load() -> None:
    for module in MODULES:
        importlib.import_module(f"{__name__}.{module}")
