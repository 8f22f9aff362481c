"""All queries of the library, and their SQL."""

from pliego.plans import catalog_queries, report_queries, source_queries

QUERIES = {**report_queries.QUERIES, **catalog_queries.QUERIES, **source_queries.QUERIES}
ORACLES = {**report_queries.ORACLES, **catalog_queries.ORACLES, **source_queries.ORACLES}
