"""Aggregates with R's missing-value semantics.

R's ``mean``/``median``/``sum`` return NA as soon as one input is NA, while
Spark's aggregates skip NULL. ``strict`` wraps an aggregate so a group with a
NULL input yields NULL (trap T1). Groups never get an extra pass: the guard is
one more count in the same aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def complete(c) -> Column:
    """TRUE when no input of the group is NULL."""
    return F.count(_col(c)) == F.count(F.lit(1))


def strict(agg: Column, c) -> Column:
    return F.when(complete(c), agg)


def strict_avg(c) -> Column:
    return strict(F.avg(_col(c)), c)


def strict_median(c) -> Column:
    """Exact interpolating median (mean of the two middle values), NA-propagating."""
    return strict(F.median(_col(c)), c)
