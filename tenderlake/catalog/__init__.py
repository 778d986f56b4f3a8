"""Registered queries over the test tables with their SQL counterparts."""

from tenderlake.catalog import aggregation, cleaning, ingest, learning, lookup, storage, streams, time_series
from tenderlake.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "aggregation", "cleaning", "ingest", "learning", "lookup", "storage", "streams",
           "time_series"]
