"""All registered queries and their SQL."""

from adlattice.plans import feed_queries, lifecycle_queries, page_queries, text_queries, vector_queries

_MODULES = [lifecycle_queries, text_queries, vector_queries, page_queries, feed_queries]

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
