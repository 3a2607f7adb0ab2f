"""Registered queries over the given tables."""

from kinetable.catalog import base, wrangling, profiles, studies, models  # noqa: F401
from kinetable.catalog.base import ORACLES, QUERIES  # noqa: F401
