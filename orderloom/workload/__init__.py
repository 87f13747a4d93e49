"""Queries that run every operator on the provided tables, with check SQL."""

from __future__ import annotations

# importing a module registers its queries
from orderloom.workload import basics, facts, gold, loads, marts  # noqa: F401
from orderloom.workload.registry import CHECKS, QUERIES


def all_queries():
    return dict(QUERIES)


def all_checks():
    return dict(CHECKS)
