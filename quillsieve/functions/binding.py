"""Bind an expression to a name inside another one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    A filter that is pushed below a projection gets a copy of the projected expression
    at every use of the column. With the value bound to a lambda variable there is one
    copy, however often the body uses it.
    """
    return F.get(F.transform(F.array(value), body), 0)
