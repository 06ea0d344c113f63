"""Best rows per key, best rows overall."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from refinery.functions import total_order

_RANK = "__rank"


def top_n_per_group(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    n: int = 1,
    settled: Sequence[str] = (),
) -> DataFrame:
    """The first ``n`` rows of each group in the given order.

    ``settled`` names columns that need not take part in the tie-break, because
    ``order`` already uses them.

    The rank filter makes Spark place a group limit on both sides of the shuffle:
    every map task sends at most ``n`` rows per group, so a group with a third of
    all rows reaches its reducer as ``n`` rows per map task.
    """
    window = Window.partitionBy(*by).orderBy(*order, *total_order(df, {*by, *settled}))
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) <= n).drop(_RANK)


def latest_per_key(
    df: DataFrame,
    key: str,
    newest_first: Sequence[Column],
    settled: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the newest, ties settled by the remaining columns."""
    return top_n_per_group(df, [key], newest_first, 1, settled)


def top_n(df: DataFrame, order: Sequence[Column], n: int, settled: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows overall: a top-k per task and a merge, never a full sort."""
    return df.orderBy(*order, *total_order(df, settled)).limit(n)
