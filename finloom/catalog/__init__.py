"""The registered queries: every operator on the given tables, with the SQL it must equal."""

from finloom.catalog import (  # noqa: F401
    digest_queries,
    job_queries,
    merge_queries,
    page_queries,
    scalar_queries,
    source_queries,
    stream_queries,
)
from finloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
