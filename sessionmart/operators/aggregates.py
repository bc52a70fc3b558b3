"""Aggregate building blocks (all declarative, partial-aggregation friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sessionmart.functions import bool_to_int


def count_if(cond: Column) -> Column:
    """``sum(case when cond then 1 else 0 end)`` -- 0 on an empty group, never NULL
    for a non-empty one; a NULL condition counts as not met."""
    return F.sum(bool_to_int(cond))


def min_where(cond: Column, value: Column | str) -> Column:
    """``min(case when cond then value end)`` -- the arg-max idiom: with a rank
    that is 1 on exactly one row per group, this picks that row's value."""
    v = F.col(value) if isinstance(value, str) else value
    return F.min(F.when(cond, v))


def ratio_pct(num: Column, den: Column) -> Column:
    """``100 * num / nullif(den, 0)`` as a double."""
    return F.lit(100.0) * num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
