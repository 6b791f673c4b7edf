"""Registered queries, one for each operator, and their SQL in DuckDB's dialect."""

from . import enrich, merges, streams, tables

_MODULES = (tables, merges, enrich, streams)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
