"""All registered queries by name, with their SQL equivalents."""

from statloom.registry import classes, fair, models, statistics, studies, tables, trees, trust  # noqa: F401
from statloom.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
