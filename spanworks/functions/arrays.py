"""Small helpers for expressions over arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lookup(table: dict, key: Column) -> Column:
    """A small fixed table as an expression; null for other keys."""
    return F.expr("map(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for kv in table.items() for x in kv) + ")")[key]
