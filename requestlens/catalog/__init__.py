"""All registered queries with their expected-result SQL."""

from requestlens.catalog import contracts, ingest, joins, marts, measures, merges, monitoring, quality, scalars, streams  # noqa: F401
from requestlens.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
