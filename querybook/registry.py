"""Query registration and the common CTEs of the SQL counterparts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from querybook.fixtures import LOADED, VIEWS, Inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
BUILDERS: dict[str, Callable[[Inputs], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = {}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def query(name: str, sql: str | None = None, stored: bool = False) -> Callable:
    """Register a function of ``Inputs`` under ``name``, with the SQL it must equal.

    ``stored``: it reads many ledgers, so they are stored first, as loaded tables are.
    """

    def register(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        BUILDERS[name] = build
        QUERIES[name] = lambda spark, sf_dir: build(Inputs(spark, sf_dir, stored))
        if sql is not None:
            ORACLES[name] = with_ctes(sql)
        return build

    return register


def cte(name: str, sql: str) -> str:
    """Define a named SQL step; ``{other}`` refers to another step or a test table."""
    if CTES.setdefault(name, sql) != sql:
        raise ValueError(f"step {name} defined twice")
    return name


def with_ctes(sql: str) -> str:
    """Complete a statement with the steps it refers to, in dependency order."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in _PLACEHOLDER.findall(text):
            if name in CTES and name not in order:
                visit(CTES[name])
                order.append(name)

    visit(sql)

    def plain(text: str) -> str:
        return _PLACEHOLDER.sub(r"\1", text)

    if not order:
        return plain(sql)
    return "WITH " + ",\n".join(f"{n} AS ({plain(CTES[n])})" for n in order) + "\n" + plain(sql)


for _name, _sql in VIEWS.items():
    cte(f"v_{_name}", _PLACEHOLDER.sub(lambda m: "{v_" + m[1] + "}" if m[1] in VIEWS else m[0], _sql))
for _name, _sql in LOADED.items():
    cte(f"b_{_name}", _PLACEHOLDER.sub(lambda m: "{v_" + m[1] + "}" if m[1] in VIEWS else m[0], _sql))
