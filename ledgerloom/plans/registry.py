"""The registered queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerloom.plans.fixtures import VIEWS, Tables, views_behind


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    """Register a query; without ``sql`` only its rows are checked."""
    def add(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = Query(build, sql)
        return build

    return add


def stand_alone(sql: str) -> str:
    """The statement with every derived view it reads as a common table expression."""
    views = [f"{name} AS ({VIEWS[name]})" for name in views_behind(sql)]
    body = sql.strip()
    if body.upper().startswith("WITH "):
        own, body = body[5:], ""
        return "WITH RECURSIVE " + ",\n".join([*views, own])
    return ("WITH RECURSIVE " + ",\n".join(views) + "\n" if views else "") + body
