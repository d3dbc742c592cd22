"""Registered queries over the provided tables, each next to its SQL."""

from __future__ import annotations

from gleanwork.workload import catalog, crawl, files, news, people  # noqa: F401
from gleanwork.workload.registry import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
