"""The register of queries: name -> plan and, where SQL can express it, its DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan under name, with the SQL that it is checked against."""

    def put(plan: Plan) -> Plan:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = plan
        if oracle is not None:
            ORACLES[name] = oracle
        return plan

    return put
