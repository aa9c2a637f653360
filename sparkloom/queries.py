"""All registered queries of the library and the SQL that gives the same rows."""

from __future__ import annotations

from .plans import assembly_queries, canonical_queries, document_queries, grid_queries, inference_queries, layout_queries, linkage_queries, profile_queries, resolve_queries, review_queries, source_queries, table_queries, text_queries

_PARTS = (text_queries, canonical_queries, linkage_queries, table_queries, document_queries, grid_queries, layout_queries, resolve_queries, review_queries, profile_queries, assembly_queries, source_queries, inference_queries)

QUERIES = {name: run for part in _PARTS for name, run in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}

#: The query that shows the library at a glance: linkage with conflict rules.
FLAGSHIP = QUERIES["J8_conflict_resolution"]
