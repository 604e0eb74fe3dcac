"""Queries of the document operators and their SQL."""

from quirelake.plans import corpus_queries, geometry_queries, layout_queries, normalize_queries, structure_queries, text_queries  # noqa: F401
from quirelake.plans.base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
