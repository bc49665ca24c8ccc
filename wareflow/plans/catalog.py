"""All registered driver queries (importing the modules registers them)."""

from __future__ import annotations

from wareflow.plans import q_derive, q_edges, q_features, q_io, q_jobs, q_kpi, q_upsert  # noqa: F401
from wareflow.plans.registry import ORACLE, QUERIES


def queries():
    return QUERIES


def oracle_sql():
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
