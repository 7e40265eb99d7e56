"""Every registered query; importing the modules registers them."""

from lagloom.plans import (  # noqa: F401
    event_queries,
    model_queries,
    panel_queries,
    piece_queries,
    source_queries,
    text_queries,
)
from lagloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
