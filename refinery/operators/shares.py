"""Share of a grand total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def share_of_total(df: DataFrame, value: str, *, few_rows: bool = False) -> Column:
    """Percentage of each row's ``value`` in the grand total, as a Column for ``df``.

    By default the total is a scalar subquery: two passes over ``df``, no row moves.
    ``few_rows=True`` is for a table whose row count has a fixed bound, such as one row
    per price tier: a window over the whole set then needs one pass only, and the one
    task it runs in sees no more than that bound.
    """
    if few_rows:
        total = F.sum(value).over(Window.partitionBy())
    else:
        total = df.agg(F.sum(value)).scalar()
    return F.lit(100).cast("decimal(4,1)") * F.col(value) / total
