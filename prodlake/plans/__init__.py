"""All registered queries of the library."""

from prodlake.plans import (
    audit_queries,
    catalog_queries,
    detail_queries,
    evidence_queries,
    layout_queries,
    ledger_queries,
    markup_queries,
    official_queries,
    product_queries,
    record_queries,
    set_queries,
    shape_queries,
    text_queries,
)
from prodlake.plans.registry import ORACLE_SQL, QUERIES

__all__ = [
    "ORACLE_SQL",
    "QUERIES",
    "audit_queries",
    "catalog_queries",
    "detail_queries",
    "evidence_queries",
    "layout_queries",
    "ledger_queries",
    "markup_queries",
    "official_queries",
    "product_queries",
    "record_queries",
    "set_queries",
    "shape_queries",
    "text_queries",
]
