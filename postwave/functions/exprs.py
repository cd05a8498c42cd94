"""Small expression helpers shared by the modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(c: Column, name: str) -> Column:
    """Evaluate ``c`` exactly once per row (for a ``select``).

    A generator's output is never substituted back into the filters and joins below it, whereas a
    plain projected column is (predicate pushdown inlines the alias); for a JSON parse that would
    parse the line again for every reference to the parsed value.
    """
    return F.explode(F.array(c)).alias(name)
