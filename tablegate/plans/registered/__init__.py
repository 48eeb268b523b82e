"""Queries over the driver's tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def registry() -> dict[str, Query]:
    from tablegate.plans.registered import audits, checks, contracts, flows, merging, rollups, sources

    found: dict[str, Query] = {}
    for module in (contracts, sources, merging, rollups, checks, audits, flows):
        for name, query in module.QUERIES.items():
            if name in found:
                raise ValueError(f"query {name} is registered twice")
            found[name] = query
    return found
