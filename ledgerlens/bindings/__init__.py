"""Driver tables bound to the roles the operators expect, one query and one SQL oracle per operator."""

from __future__ import annotations

import functools

from ..sources.session import tune
from . import audit_queries, balance_queries, ledger_queries, period_queries, run_queries, snapshot_queries

MODULES = (period_queries, snapshot_queries, ledger_queries, audit_queries, balance_queries, run_queries)


def _tuned(query):
    @functools.wraps(query)
    def run(spark, sf_dir):
        return query(tune(spark), sf_dir)

    return run


def queries() -> dict:
    return {name: _tuned(q) for module in MODULES for name, q in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
