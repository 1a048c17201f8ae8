"""Registered queries: one per operator, with the SQL that checks it where SQL can."""

from flowmedallion.queries.registry import REGISTRY, Query  # noqa: F401
from flowmedallion.queries import (  # noqa: F401
    cleaning_queries,
    digest_queries,
    evaluation_queries,
    feature_queries,
    learning_queries,
    report_queries,
    source_queries,
    split_queries,
)
