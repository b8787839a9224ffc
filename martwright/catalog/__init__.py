"""Registered queries over the sample star, and their oracle SQL."""

from .oracle import oracle_sql
from .queries import queries

__all__ = ["oracle_sql", "queries"]
