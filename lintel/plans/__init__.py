"""Queries built from the operators, with their SQL twins."""

from . import detail_queries, form_queries, merge_queries, serve_queries, summary_queries, text_queries

_PARTS = (summary_queries, serve_queries, merge_queries, text_queries, detail_queries, form_queries)
QUERIES = {name: q for part in _PARTS for name, q in part.QUERIES.items()}
ORACLE_SQL = {name: sql for part in _PARTS for name, sql in part.ORACLE_SQL.items()}
