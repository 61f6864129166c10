"""Dictionary lookups as map literals: no join, no UDF."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode(code: Column, table: dict, default=None) -> Column:
    """Value of ``code`` in ``table``; ``default`` for codes not in it, NULL included."""
    entries = [F.lit(part) for pair in table.items() for part in pair]
    value = F.create_map(*entries)[code]
    return value if default is None else F.coalesce(value, F.lit(default))


def rank_in(value: Column, ordered: Iterable) -> Column:
    """Position of ``value`` in an ordered category list, NULL if it is not in it."""
    return decode(value, {item: position for position, item in enumerate(ordered)})
