"""All queries of the reference's operators, and the SQL of each."""

from __future__ import annotations

from tidegauge.plans import oracles, queries, scans, stored, temporal

QUERIES = queries.QUERIES | temporal.QUERIES | stored.QUERIES | scans.QUERIES
ORACLES = oracles.ORACLES | temporal.ORACLES | stored.ORACLES | scans.SQL
