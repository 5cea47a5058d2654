"""Keep an expensive expression from being copied into pushed-down filters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def once(frame: DataFrame, name: str, expression: Column) -> DataFrame:
    """Add a column that is evaluated exactly once per row.

    A filter on an ordinary computed column is moved below its projection and
    evaluates the expression a second time, which doubles the cost of an XML
    parse.  The output of a generator is not rewritten that way, and a
    one-element array makes the generator emit each row once.
    """
    return frame.select("*", F.explode_outer(F.array(expression)).alias(name))


def bound(value: Column, build: Callable[[Column], Column]) -> Column:
    """``build(value)`` with the value evaluated once, however often the result reads it."""
    return F.get(F.transform(F.array(value), build), F.lit(0))
