"""All registered queries and their oracles."""

from __future__ import annotations

from trackmart.queries import models, plays  # noqa: F401  (registers their queries)
from trackmart.queries.catalogue import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
