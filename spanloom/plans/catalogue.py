"""All registered queries of the library's own operators, and their DuckDB SQL."""

from __future__ import annotations

from spanloom.plans import document_queries, file_queries, interval_queries, rule_queries, table_queries

QUERIES = interval_queries.QUERIES | table_queries.QUERIES | rule_queries.QUERIES | document_queries.QUERIES | file_queries.QUERIES
SQL = interval_queries.SQL | table_queries.SQL | rule_queries.SQL | document_queries.SQL | file_queries.SQL
