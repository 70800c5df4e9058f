"""Registered queries; importing this package fills the registry."""

from gaugework.catalog import crosssection, facts, history, people, quality, scoring, text, timeseries, validate  # noqa: F401
from gaugework.catalog.registry import QUERIES, SQL  # noqa: F401
