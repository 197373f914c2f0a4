"""Naming a value inside a column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once for each row, however often ``use`` names it.

    A function of an array is also not pasted into the code that Spark generates for a stage. The JVM never compiles a
    method of more than 8,000 bytes, and the matchers of all fields together are several times that.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
