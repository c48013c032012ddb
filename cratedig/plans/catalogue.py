"""All registered queries."""

from cratedig.plans.registry import CHECKS, QUERIES
from cratedig.plans import catalog_queries, entity_queries, flow_queries, metric_queries, queue_queries, text_queries  # noqa: F401

__all__ = ["QUERIES", "CHECKS"]
