"""Naming a value inside an expression, so that it is worked out once.

Catalyst may inline a column where it is used, and expressions inside the lambdas of array functions aren't
shared; a lambda's own variable is, however often its body names it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
