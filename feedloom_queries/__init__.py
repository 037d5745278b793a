"""Registered queries: every operator over the driver's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedloom_queries import archives, buckets, casts, checks, fanout, loads, scans, values

_MODULES = (scans, values, checks, fanout, casts, loads, archives, buckets)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
