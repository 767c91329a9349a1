"""Bind an intermediate value once inside a column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A column that is mentioned inside a higher-order function's lambda would
    be evaluated again for every element; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
