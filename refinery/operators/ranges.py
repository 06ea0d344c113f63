"""Joining values with ranges by equality of bins, never by comparing all pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

_LEVEL, _BIN = "__level", "__bin"
#: The level of ranges with an open end: one bin for all values.
OPEN = 10_000


def _bin(value: Column, level: Column) -> Column:
    return F.when(level == OPEN, F.lit(0)).otherwise(F.floor(value.cast("double") / F.pow(F.lit(2.0), level))).cast("bigint")


def range_join(
    values: DataFrame, ranges: DataFrame, value: str, *, lower: str = "lower", upper: str = "upper", by: Sequence[str] = ()
) -> DataFrame:
    """Each row of ``values`` with each range, ``lower`` <= value < ``upper``, that holds it; equal on ``by``.

    A NULL bound is open, and a NULL value lies above all others: only ranges without an upper bound
    hold it. Ranges may overlap and may be of any lengths: a range of a length up to 2^k lies in two or
    three bins of that width, and values are looked up in the bins of each k that occurs. A range that
    is empty or has a NaN bound holds nothing. The other columns of the sides must differ.
    """
    length = F.col(upper).cast("double") - F.col(lower).cast("double")
    level = F.when(F.col(lower).isNull() | F.col(upper).isNull(), OPEN).when(length > 0, F.ceil(F.log2(length)))
    levelled = ranges.withColumn(_LEVEL, level.cast("int")).where(F.col(_LEVEL).isNotNull())
    # One row per power of two that occurs as a length.
    levels = [row[0] for row in levelled.select(_LEVEL).distinct().collect()]
    ends = [_bin(F.col(end), F.col(_LEVEL)) for end in (lower, upper)]
    binned = levelled.withColumn(_BIN, F.explode(F.sequence(*ends)))
    asked = values.withColumn(_LEVEL, F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>")))
    asked = asked.withColumn(_BIN, _bin(F.col(value), F.col(_LEVEL)))
    joined = asked.join(binned, [*by, _LEVEL, _BIN])
    above = F.col(lower).isNull() | F.col(value).isNull() | (F.col(value) >= F.col(lower))
    below = F.col(upper).isNull() | F.coalesce(F.col(value) < F.col(upper), F.lit(False))
    return joined.where(above & below).drop(_LEVEL, _BIN)
