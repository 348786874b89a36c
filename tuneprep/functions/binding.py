"""Evaluate an expression once and use it many times inside one column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(values: dict[str, Column], body: Callable[[Callable[[str], Column]], Column]) -> Column:
    """``body(get)`` where ``get(name)`` is the value of ``values[name]``, evaluated once per row.

    A lambda that mentions an outer expression evaluates it again for every element, which makes a
    linear pass quadratic. Bound values are lambda variables: plain field reads.
    """
    row = F.array(F.struct(*[value.alias(name) for name, value in values.items()]))
    return F.get(F.transform(row, lambda bound: body(lambda name: bound[name])), F.lit(0))
