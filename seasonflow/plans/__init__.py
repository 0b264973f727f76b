"""Query catalogue: importing this package registers every query."""

from . import forecasting, groups, io, ordering, scalars, season, shaping  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
