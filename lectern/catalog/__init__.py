"""Registered queries: each operator on the given tables, with its SQL twin."""

from lectern.catalog.base import ORACLES, QUERIES
from lectern.catalog import texts, timelines, calls, replies, reviews, selection, logs, streams, files  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
