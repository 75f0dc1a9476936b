"""Registered queries over the driver tables, each next to its independent oracle SQL."""

from dunlin.catalog import (  # noqa: F401
    core, measures, models, reports, shapes, stores,
)
from dunlin.catalog.base import QUERIES, oracle_texts  # noqa: F401
