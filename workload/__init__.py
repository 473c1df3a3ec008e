"""The registered queries: every operator run over the given tables, with its SQL check."""

from workload import (  # noqa: F401
    join_queries,
    landing_queries,
    model_queries,
    profile_queries,
    selection_queries,
    stream_queries,
    table_queries,
    time_queries,
)
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
