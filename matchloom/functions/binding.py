"""Using a value several times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column | str, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value computed once per row however often the body uses it.

    Spark puts the definition of a column in place of its name when it merges projections or
    moves filters down. An expression that names its input several times then repeats the work
    below it each time, and nested ones multiply. Here the input appears once.
    """
    value = F.col(value) if isinstance(value, str) else value
    return F.get(F.transform(F.array(value), body), 0)
