"""All queries and their check SQL."""

from . import job_queries, status_queries, stream_queries, text_queries  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
