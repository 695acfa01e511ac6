"""Queries by name, and the SQL that gives the same rows."""

from changeloom.plans import stream_queries, value_queries

QUERIES: dict = stream_queries.QUERIES | value_queries.QUERIES
ORACLES: dict = stream_queries.ORACLES | value_queries.ORACLES
