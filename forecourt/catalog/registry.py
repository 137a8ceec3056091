"""All registered queries by name."""

from __future__ import annotations

from forecourt.catalog import gold_queries, silver_queries

QUERIES = {**gold_queries.QUERIES, **silver_queries.QUERIES}
ORACLES = {**gold_queries.ORACLES, **silver_queries.ORACLES}
