"""Bind a value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, not once per array element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
