"""All registered queries. Importing the modules fills the registry."""

from riskloom.plans import (  # noqa: F401
    evaluation_queries, feature_queries, item_queries, profile_queries, service_queries, source_queries, streaming_queries,
    training_queries,
)
from riskloom.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
