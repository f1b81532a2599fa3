"""Registered queries over the driver tables, and the SQL each one is checked against."""

from tidelog.plans import analysis, application, arrival, drift, ingestion, reports, writing  # noqa: F401
from tidelog.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
