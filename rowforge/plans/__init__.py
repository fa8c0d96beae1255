"""The registered queries: each operator run over the given tables, with its SQL counterpart."""

from rowforge.plans import (  # noqa: F401  (importing registers the queries)
    cleaning,
    history,
    increments,
    joins,
    rules,
    selections,
    statistics,
    words,
)
from rowforge.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
