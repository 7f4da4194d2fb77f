"""Registered queries over the driver's tables, each with its DuckDB oracle."""

from keyfold.plans.registry import QUERIES, ORACLE, load_all

__all__ = ["QUERIES", "ORACLE", "load_all"]
