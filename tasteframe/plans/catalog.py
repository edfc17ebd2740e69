"""All registered queries."""

from __future__ import annotations

from tasteframe.plans import (  # noqa: F401
    queries_basic, queries_eval, queries_features, queries_io, queries_models, queries_recommend,
)
from tasteframe.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
