"""All core queries and their SQL, by name."""

from __future__ import annotations

from folioforge.plans import data_quality, reference_queries

QUERIES = data_quality.QUERIES | reference_queries.QUERIES
ORACLES = data_quality.ORACLES | reference_queries.ORACLES
