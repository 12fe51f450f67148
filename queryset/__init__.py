"""Checked queries over the driver tables: Spark plans and their DuckDB equivalents."""

from queryset.registry import ORACLES, QUERIES  # noqa: F401
from queryset import ingestion, profiles, scoring, topics, vectors  # noqa: F401
