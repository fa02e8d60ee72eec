"""All registered queries (one per operator of the survey) and their DuckDB oracles.

Importing this module imports every family module, which registers its queries.
"""

from __future__ import annotations

from runledger.plans.queries import (  # noqa: F401  (imported for registration, in this order)
    config,
    documents,
    graph,
    joins,
    quality,
    runs,
    sources,
    streaming,
    text,
)
from runledger.plans.queries.registry import ORACLE, QUERIES, register

__all__ = ["ORACLE", "QUERIES", "register"]
