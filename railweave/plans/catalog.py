"""Every registered query. Importing the modules fills the registry."""

from __future__ import annotations

from railweave.plans import (  # noqa: F401
    ingest_queries,
    model_queries,
    operations_queries,
    serving_queries,
)
from railweave.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
