"""Importing this module registers every query."""

from payfeed.catalog import (  # noqa: F401
    delivery_queries,
    feed_queries,
    rule_queries,
    structure_queries,
)
from payfeed.catalog.registry import ORACLES, QUERIES  # noqa: F401
