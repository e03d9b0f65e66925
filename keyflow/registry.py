"""Queries over the library's operators, and the SQL that each has to agree with."""

from __future__ import annotations

from keyflow.plans import logs, outcomes  # noqa: F401  add their queries
from keyflow.plans.queries import ORACLES, QUERIES, flagship

__all__ = ["flagship", "oracle_sql", "queries"]


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
