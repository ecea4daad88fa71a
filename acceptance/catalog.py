"""All acceptance queries."""

from acceptance import (  # noqa: F401
    cleaning_queries,
    score_queries,
    source_queries,
    spatial_queries,
    job_queries,
)
from acceptance.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
