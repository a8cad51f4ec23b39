"""First and last values of a group, as ordinary aggregates.

They replace a pair of opposite row numbers: no window, and the partial aggregate runs
before the shuffle. The order is a struct, which a hash aggregate cannot update in place, so
Spark plans a SortAggregate: rows are sorted by group within their task on either side of
the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def value_at_first(value: Column, *order: Column) -> Column:
    """``value`` of the row that comes first in ``order`` (NULLs first)."""
    return F.min_by(value, F.struct(*order))


def value_at_last(value: Column, *order: Column) -> Column:
    """``value`` of the row that comes last in ``order``."""
    return F.max_by(value, F.struct(*order))
