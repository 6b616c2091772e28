"""The queries and the oracles under their common names."""

from __future__ import annotations

from spendmill.verify import mart_queries, operator_queries, oracles, run_queries, wire_queries  # noqa: F401 - they register themselves
from spendmill.verify.queries import Query
from spendmill.verify import queries as report_queries


def queries() -> dict[str, Query]:
    return {**report_queries.queries(), **operator_queries.QUERIES}


def oracle_sql() -> dict[str, str]:
    found = {f"scan_{name}": oracles.scan_fact(name) for name in oracles.FACTS}
    found.update({f"load_{name}": oracles.load_fact(name) for name in oracles.FACTS})
    for name, sql in oracles.DIMENSIONS.items():
        found[f"scan_{name}"] = found[f"load_{name}"] = sql
    return {**found, **operator_queries.ORACLES}
