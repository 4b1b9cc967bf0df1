"""All single-operator queries."""

from . import join_steps, landing_steps, load_steps  # noqa: F401  (importing registers their queries)
from .column_steps import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
