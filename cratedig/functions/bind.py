"""Naming a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluates ``value`` once per row for an expression that reads it many times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
