"""Registered queries and, for each, the SQL that a second engine runs on the same tables."""

from catalogue import cleaning, consolidation, files, fixes, landing, panel, quality, review, warehouse

_PARTS = (panel, quality, cleaning, consolidation, review, warehouse, fixes, files, landing)
QUERIES = {name: run for part in _PARTS for name, run in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
