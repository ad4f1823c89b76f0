"""Registered queries and their SQL counterparts over the TPC-H-like tables."""

from delaykit.catalogue import (  # noqa: F401 - importing registers the queries
    audit_queries,
    closed_form_queries,
    evaluation_queries,
    feature_queries,
    io_queries,
    join_queries,
    model_queries,
    rank_queries,
    statistics_queries,
)
from delaykit.catalogue.registry import REGISTRY

__all__ = ["REGISTRY"]
