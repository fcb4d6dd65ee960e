"""Importing this module registers every query."""

from weftline.plans import aggregates, joins, layout, quality, rows, samples, streams, summaries, windows  # noqa: F401
from weftline.plans.registry import QUERIES, SQL  # noqa: F401
