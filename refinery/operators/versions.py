"""What changed between two versions of a table, by one aggregation instead of joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

COUNT, CHANGE = "__count", "change"


def _both(old: DataFrame, new: DataFrame) -> DataFrame:
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError("the versions have different columns")
    return old.withColumn(COUNT, F.lit(-1)).unionByName(new.withColumn(COUNT, F.lit(1)))


def diff_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that ``new`` has more or fewer of: ``__count`` says how many more, negative for fewer.

    Repeated rows count as often as they occur; NULLs are equal to each other. Rows of both
    versions cancel out before the shuffle where they meet, else in it.
    """
    grouped = _both(old, new).groupBy(*[f"`{name}`" for name in old.columns]).agg(F.sum(COUNT).alias(COUNT))
    return grouped.where(F.col(COUNT) != 0)


def apply_rows(old: DataFrame, changes: DataFrame) -> DataFrame:
    """The new version from the old one and what :func:`diff_rows` gave."""
    counted = old.withColumn(COUNT, F.lit(1).cast("bigint")).unionByName(changes)
    left = counted.groupBy(*[f"`{name}`" for name in old.columns]).agg(F.sum(COUNT).alias(COUNT))
    repeats = F.explode(F.array_repeat(F.lit(1), F.col(COUNT).cast("int")))
    return left.where(F.col(COUNT) > 0).withColumn(COUNT, repeats).drop(COUNT)


def diff_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Per changed key: ``change`` (insert, update or delete) and the rows ``before`` and ``after``.

    Both versions hold a key once. NULL is a key like others.
    """
    row = F.struct(*[f"`{name}`" for name in old.columns])

    def side(count: int) -> Column:
        return F.max(F.when(F.col(COUNT) == count, row))

    paired = _both(old, new).groupBy(key).agg(side(-1).alias("before"), side(1).alias("after"))
    change = F.when(F.col("before").isNull(), "insert").when(F.col("after").isNull(), "delete").otherwise("update")
    changed = paired.where(~F.col("before").eqNullSafe(F.col("after")))
    return changed.select(key, change.alias(CHANGE), "before", "after")
