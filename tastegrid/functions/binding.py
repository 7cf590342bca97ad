"""Name a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the value, worked out once.

    An expression captured by a higher-order function is evaluated again for every element; binding it
    to a lambda variable first avoids that.
    """
    return F.transform(F.array(value), body)[0]


def let_all(body: Callable[..., Column], **values: Column) -> Column:
    """``let`` for several independent values, passed by name."""
    packed = F.struct(*[v.alias(k) for k, v in values.items()])
    return let(packed, lambda s: body(**{k: s[k] for k in values}))
