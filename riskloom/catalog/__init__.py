"""Registered queries over the driver's tables, each with its check in SQL where SQL can express it."""

from riskloom.catalog.registry import CATALOG
from riskloom.catalog import (  # noqa: F401
    rollups, expressions, aggregates, encoding, sources, quality, evaluation, modelling, scoring,
)

__all__ = ["CATALOG"]
