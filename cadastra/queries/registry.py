"""Registered queries and the SQL text each one is checked against."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cadastra.session import pin

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DERIVED: dict[str, str] = {}
# Intermediate results spelled out in SQL, for the checks of queries that build on them.
CHECK_PARTS: dict[str, str] = {}


class Tables:
    """Lazy access to the given tables and to the tables derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._given: dict[str, DataFrame] = {}
        self._derived: dict[str, DataFrame] = {}
        self._stored: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            if name not in self._given:
                self._given[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            return self._given[name]
        if name in DERIVED:
            return self.derived(name)
        raise AttributeError(name)

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table that several parts of one query read, computed once."""
        if name not in self._stored:
            self._stored[name] = pin(build())
        return self._stored[name]

    def derived(self, name: str) -> DataFrame:
        if name not in self._derived:
            text = DERIVED[name]
            inputs = {n: getattr(self, n) for n in sorted(set(re.findall(r"\{(\w+)\}", text)))}
            self._derived[name] = self.spark.sql(text, **inputs)
        return self._derived[name]


def query(name: str, sql: str | None = None, needs: tuple[str, ...] = ()):
    """Register a query. ``needs`` names derived tables that the SQL text refers to; their
    definitions (the same text Spark runs) are put in front of it."""

    def keep(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(spark, folder))

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_derived(sql, needs)
        return build

    return keep


def with_derived(sql: str, needs: tuple[str, ...]) -> str:
    """``sql`` preceded by the tables it needs, in the order of their dependencies."""
    if not needs:
        return sql.strip()
    texts = {**DERIVED, **CHECK_PARTS}
    ordered: list[str] = []

    unknown = set(needs) - set(texts)
    if unknown:
        raise KeyError(f"not defined yet: {sorted(unknown)}")

    def visit(name: str) -> None:
        if name in ordered or name not in texts:
            return
        for inner in re.findall(r"\{(\w+)\}", texts[name]):
            visit(inner)
        ordered.append(name)

    for name in needs:
        visit(name)
    parts = [f"{n} AS ({re.sub(r'[{](\w+)[}]', r'\1', texts[n]).strip()})" for n in ordered]
    body = sql.strip()
    rest = ",\n" + body[5:] if body[:5].upper() == "WITH " else "\n" + body
    return "WITH " + ",\n".join(parts) + rest
