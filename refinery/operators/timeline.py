"""Rows of a key in the order of time: validity intervals, and the state at a point in time.

A key with a third of all rows must not be one task. So time is cut into slices, and the windows run
within a key and a slice. What a slice needs from others is one row per key and slice: the last
state before it, or the next change behind it. Those rows are aggregated before they are shuffled,
carried over by a window over the slices of a key, and put among the rows of their slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

VALID_FROM, VALID_TO = "valid_from", "valid_to"
DAY = 86_400
_KEY, _SLICE, _AT, _STATE, _KIND, _ROW = "__key", "__slice", "__at", "__state", "__kind", "__row"
# The kinds of rows in a slice, in the order in which they count at one moment.
_CARRIED, _CHANGE, _ASKED = -1, 0, 1


def _slice(at: Column, seconds: int) -> Column:
    return F.floor(F.unix_micros(at.cast("timestamp")) / (seconds * 1_000_000))


def _states(df: DataFrame, key: str, at: str, values: Sequence[str], seconds: int) -> DataFrame:
    """One state per key and moment: of several the greatest. Rows without a moment belong to no time."""
    state = F.struct(*[F.col(f"`{name}`").alias(name) for name in values])
    rows = df.where(F.col(at).isNotNull()).select(F.col(key).alias(_KEY), F.col(at).alias(_AT), state.alias(_STATE))
    return rows.groupBy(_KEY, _AT).agg(F.max(_STATE).alias(_STATE)).withColumn(_SLICE, _slice(F.col(_AT), seconds))


def history(df: DataFrame, key: str, at: str, values: Sequence[str], *, seconds: int = DAY) -> DataFrame:
    """Each state of a key with the time from which and until which it held.

    Consecutive rows with equal ``values`` are one state. ``valid_to`` is the moment of the next one,
    NULL for the last. Of several rows of a key at one moment the one with the greatest values
    counts; rows without a moment are left out; NULL is a key like others. ``seconds`` is the width of
    a slice.
    """
    states = _states(df, key, at, values, seconds)
    by_slice = Window.partitionBy(_KEY).orderBy(_SLICE)
    last = states.groupBy(_KEY, _SLICE).agg(F.max_by(_STATE, _AT).alias(_STATE))
    before = last.select(_KEY, _SLICE, F.lag(_STATE).over(by_slice).alias(_STATE)).where(F.col(_STATE).isNotNull())
    rows = states.withColumn(_KIND, F.lit(_CHANGE)).unionByName(before.withColumns({_KIND: F.lit(_CARRIED), _AT: _no_moment(states)}))
    within = Window.partitionBy(_KEY, _SLICE).orderBy(F.col(_KIND) != _CARRIED, _AT)
    rows = rows.withColumn("__before", F.lag(_STATE).over(within))
    starts = rows.where((F.col(_KIND) == _CHANGE) & ~F.col(_STATE).eqNullSafe(F.col("__before"))).select(_KEY, _SLICE, _AT, _STATE, _KIND)

    first = starts.groupBy(_KEY, _SLICE).agg(F.min(_AT).alias(_AT))
    behind = first.select(_KEY, _SLICE, F.lead(_AT).over(by_slice).alias(_AT)).where(F.col(_AT).isNotNull())
    nothing = F.lit(None).cast(starts.schema[_STATE].dataType)
    ends = starts.unionByName(behind.withColumns({_STATE: nothing, _KIND: F.lit(_CARRIED)}))
    until = F.lead(_AT).over(Window.partitionBy(_KEY, _SLICE).orderBy(_AT))
    intervals = ends.withColumn(VALID_TO, until).where(F.col(_KIND) == _CHANGE)
    return intervals.select(F.col(_KEY).alias(key), f"{_STATE}.*", F.col(_AT).alias(VALID_FROM), VALID_TO)


def _no_moment(rows: DataFrame) -> Column:
    return F.lit(None).cast(rows.schema[_AT].dataType)


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    *,
    left_at: str,
    right_at: str,
    values: Sequence[str],
    found_at: str = "as_of",
    seconds: int = DAY,
) -> DataFrame:
    """Each row of ``left`` with the ``values`` that ``right`` had for its key at its moment.

    That is the last row of ``right`` at or before ``left_at``, its moment in ``found_at``; NULLs where
    there is none, or where the left row has no key or no moment. Of several right rows of a key at
    one moment the one with the greatest values counts. Every left row comes out once. Both sides are
    put into one sequence per key and slice, so no row is compared with a range of others.
    """
    clashing = {*values, found_at} & set(left.columns)
    if clashing:
        raise ValueError(f"columns of both sides: {sorted(clashing)}")
    moment = right.schema[right_at].dataType
    states = _states(right.where(F.col(key).isNotNull()), key, right_at, [right_at, *values], seconds)
    changes = states.select(_KEY, _SLICE, _AT, F.lit(_CHANGE).alias(_KIND), _STATE)
    kind = states.schema[_STATE].dataType
    row = F.struct(*[F.col(f"`{name}`").alias(name) for name in left.columns]).alias(_ROW)
    # In the type of the right side's moments, so that both are in one order.
    at = F.col(left_at).cast(moment)
    timed = F.col(key).isNotNull() & at.isNotNull()
    asked = left.where(timed).select(
        F.col(key).cast(states.schema[_KEY].dataType).alias(_KEY), _slice(at, seconds).alias(_SLICE), at.alias(_AT),
        F.lit(_ASKED).alias(_KIND), F.lit(None).cast(kind).alias(_STATE), row,
    )

    last = changes.groupBy(_KEY, _SLICE).agg(F.max_by(_STATE, _AT).alias(_STATE))
    slices = last.unionByName(asked.select(_KEY, _SLICE, _STATE).groupBy(_KEY, _SLICE).agg(F.any_value(_STATE).alias(_STATE)))
    slices = slices.groupBy(_KEY, _SLICE).agg(F.any_value(_STATE, F.lit(True)).alias(_STATE))
    earlier = Window.partitionBy(_KEY).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select(_KEY, _SLICE, F.last(_STATE, ignorenulls=True).over(earlier).alias(_STATE)).where(F.col(_STATE).isNotNull())
    carried = carried.withColumns({_AT: F.lit(None).cast(moment), _KIND: F.lit(_CARRIED)})

    no_row = F.lit(None).cast(asked.schema[_ROW].dataType)
    sequence = asked.unionByName(changes.withColumn(_ROW, no_row)).unionByName(carried.withColumn(_ROW, no_row))
    so_far = Window.partitionBy(_KEY, _SLICE).orderBy(F.col(_KIND) != _CARRIED, _AT, _KIND).rowsBetween(Window.unboundedPreceding, 0)
    found = sequence.withColumn(_STATE, F.last(_STATE, ignorenulls=True).over(so_far)).where(F.col(_KIND) == _ASKED)
    untimed = left.where(~F.coalesce(timed, F.lit(False))).select(row, F.lit(None).cast(kind).alias(_STATE))
    state = F.col(_STATE)
    return found.select(_ROW, _STATE).unionByName(untimed).select(
        f"{_ROW}.*", state[right_at].alias(found_at), *[state[name].alias(name) for name in values]
    )
