"""Upsert by key and the late-arrival report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from refinery.functions import instant, sortable_values, utc_date
from refinery.operators.ranking import latest_per_key

SOURCE_FILE = "_source_file"
LANDED_ON = "ingest_date"


def upsert(target: DataFrame, changes: DataFrame, key: str, order: str) -> DataFrame:
    """Per key the row with the greatest ``order`` from either side; keys may repeat in both.

    An older change therefore never replaces a newer target row, and applying the
    same changes twice gives the same table. The whole target is shuffled, one row per
    key and map task; :func:`merge_unique` avoids that for a stored silver table.
    """
    both = target.unionByName(changes, allowMissingColumns=True)
    return latest_per_key(both, key, [instant(both, order).desc()])


def merge_unique(
    target: DataFrame,
    changes: DataFrame,
    key: str,
    order: str,
    *,
    broadcast_changes: bool = False,
) -> DataFrame:
    """:func:`upsert` for a target and changes that both hold one row per key.

    Joins on a key that occurs once on each side, so no key is hot. With
    ``broadcast_changes``, for changes of a checked size, target rows stay in the task that
    read them. Otherwise Spark chooses by its own threshold, above which both sides are
    shuffled. Both inputs are read more than once: store them first.
    """
    target, changes = _same_columns(target, changes)
    names = target.columns
    hinted = F.broadcast if broadcast_changes else lambda side: side

    incoming = changes.select(key, F.struct(*[f"`{n}`" for n in names]).alias("__new"))
    # One comparison of structs: by order column, then by all the others, NULL lowest.
    newer = _rank_of(target, key, order, "__new.") > _rank_of(target, key, order)
    replaced = F.col("__new").isNotNull() & newer
    kept_or_replaced = target.join(hinted(incoming), key, "left").select(
        *[F.when(replaced, F.col(f"__new.`{n}`")).otherwise(F.col(f"`{n}`")).alias(n) for n in names]
    )
    known = target.select(key).join(hinted(changes.select(key)), key, "left_semi")
    added = changes.join(hinted(known), key, "left_anti").select(*[f"`{n}`" for n in names])
    return kept_or_replaced.unionByName(added)


def _same_columns(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    def filled(df: DataFrame, other: DataFrame) -> DataFrame:
        missing = {
            f.name: F.lit(None).cast(f.dataType) for f in other.schema.fields if f.name not in df.columns
        }
        return df.withColumns(missing) if missing else df

    left, right = filled(left, right), filled(right, left)
    return left, right.select(*[f"`{name}`" for name in left.columns])


def _rank_of(df: DataFrame, key: str, order: str, inside: str = "") -> Column:
    return F.struct(instant(df, order, inside), *sortable_values(df, {key}, inside))


def late_arrivals(
    bronze: DataFrame,
    ingested_at: str = "_ingested_at",
    allowed_days: int = 0,
) -> DataFrame:
    """Rows that landed more than ``allowed_days`` days after they were stamped.

    The landing date is the ``ingest_date`` column, or else is taken from the
    ``ingest_date=`` directory in the row's source file.
    """
    if LANDED_ON in bronze.columns:
        landed = F.col(LANDED_ON).cast("date")
    else:
        landed = F.regexp_extract(SOURCE_FILE, LANDED_ON + r"=(\d{4}-\d{2}-\d{2})", 1).try_cast("date")
    return (
        bronze.withColumns({LANDED_ON: landed, "ingested_on": utc_date(bronze, ingested_at)})
        .withColumn("days_late", F.date_diff(LANDED_ON, "ingested_on"))
        .filter(F.col("days_late") > allowed_days)
    )
