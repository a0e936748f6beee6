"""Registered queries with their SQL twins, and the composite jobs."""

from .registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
