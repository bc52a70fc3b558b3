"""Join operators: plain joins on keys; adaptive execution picks their form from measured sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def preserving_left_join(left: DataFrame, right: DataFrame, on: Column | Sequence[str]) -> DataFrame:
    """Left outer join; never shrinks the left side.

    It also never grows it as long as the right key is unique -- the
    ``unique_combination`` checks on the right-hand models guard that.
    """
    return left.join(right, on, "left")


def reduce_to_keys(big: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``big`` whose key is among ``keys`` (semi join).

    Used before per-key work (windows / aggregates partitioned by ``on``) so
    that the work runs only for keys that will be joined.
    """
    return semi_join(big, keys, on)


def semi_join(df: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows of ``df`` whose key appears in ``keys`` (EXISTS)."""
    on = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*on).distinct(), on, "left_semi")


def anti_join(df: DataFrame, keys: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows of ``df`` whose non-NULL key has no match in ``keys`` (NOT EXISTS).

    NULL keys are excluded first: a NULL reference is not a broken reference.
    """
    on = [on] if isinstance(on, str) else list(on)
    not_null = F.lit(True)
    for c in on:
        not_null = not_null & F.col(c).isNotNull()
    return df.where(not_null).join(keys.select(*on).distinct(), on, "left_anti")


def set_overlap(a: DataFrame, b: DataFrame, keys: Sequence[str],
                a_name: str = "a", b_name: str = "b") -> DataFrame:
    """Distinct key sets of ``a`` and ``b`` compared in one full outer join.

    Returns one row: size of each set, keys in both, only in ``a``, only in
    ``b``, and the overlap as a percentage of ``a``.
    """
    ka = a.select(*keys).distinct().withColumn("_in_a", F.lit(True))
    kb = b.select(*keys).distinct().withColumn("_in_b", F.lit(True))
    j = ka.join(kb, list(keys), "full_outer")
    in_a, in_b = F.col("_in_a").isNotNull(), F.col("_in_b").isNotNull()

    def cnt(c: Column) -> Column:
        return F.sum(F.when(c, F.lit(1)).otherwise(F.lit(0))).cast("bigint")

    agg = j.agg(cnt(in_a).alias(f"{a_name}_total"),
                cnt(in_b).alias(f"{b_name}_total"),
                cnt(in_a & in_b).alias("in_both"),
                cnt(in_a & ~in_b).alias(f"{a_name}_only"),
                cnt(~in_a & in_b).alias(f"{b_name}_only"))
    return agg.withColumn(
        "overlap_pct",
        F.lit(100.0) * F.col("in_both") / F.nullif(F.col(f"{a_name}_total").cast("double"),
                                                   F.lit(0.0)))
