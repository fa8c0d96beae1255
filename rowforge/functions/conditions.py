"""Conditional columns: code tables, ordered rules, prefix tests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import chain
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_value(col: str | Column, mapping: Mapping[Any, Any], default: Any) -> Column:
    """Look a value up in a small code table; ``default`` when absent or null.

    The mapping is a folded map literal, so this is for code tables that fit
    in the query text. Use ``operators.decode_join`` for a mapping held as a
    table.
    """
    if not mapping:
        raise ValueError("mapping must not be empty")
    column = F.col(col) if isinstance(col, str) else col
    table = F.create_map(*(F.lit(item) for item in chain.from_iterable(mapping.items())))
    return F.coalesce(F.try_element_at(table, column), F.lit(default))


def first_match(rules: Sequence[tuple[Column, Any]], default: Any) -> Column:
    """Label of the first rule whose condition holds; a null condition does not hold."""
    if not rules:
        raise ValueError("rules must not be empty")
    (condition, label), *others = rules
    chosen = F.when(condition, F.lit(label))
    for condition, label in others:
        chosen = chosen.when(condition, F.lit(label))
    return chosen.otherwise(F.lit(default))


def starts_with_any(col: str | Column, prefixes: Sequence[str]) -> Column:
    """Case-insensitive test that the text starts with one of ``prefixes``."""
    column = F.lower(F.col(col) if isinstance(col, str) else col)
    tests = [column.startswith(prefix.lower()) for prefix in prefixes]
    return reduce(lambda a, b: a | b, tests, F.lit(False))
