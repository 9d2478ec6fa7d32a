"""Registered queries over the given tables, each with SQL to check it against."""

from catalog import community, gears, matching, projections, selections, sheets, statistics, summaries, views  # noqa: F401
from catalog.registry import QUERIES, SQL  # noqa: F401
