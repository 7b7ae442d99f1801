"""Queries over the given tables, each with the SQL it is checked against."""

from cadastra.queries import aggregates, columns, joins, loads, recipes, texts  # noqa: F401
from cadastra.queries.registry import ORACLES, QUERIES, Tables  # noqa: F401
