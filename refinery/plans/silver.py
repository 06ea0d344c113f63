"""Silver: typed, normalized, one row per key."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from refinery.contracts import SILVER
from refinery.functions import (
    has_rating,
    instant,
    is_text,
    is_valid,
    normalized,
    to_double,
    to_whole_number,
)
from refinery.operators.ranking import latest_per_key
from refinery.operators.rejects import (
    CORRUPT,
    KEY,
    PRICE,
    REASON,
    accepted,
    checked,
    rejected,
    typed_key,
    typed_price,
    usable,
)
from refinery.roles import DEFAULT_ROLES, Roles
from refinery.sources.tables import read_bronze
from refinery.storage import (
    drop_table,
    has_files,
    publish,
    table_exists,
    together_by,
)

LOADED_AT = "_silver_loaded_at"


def flatten_rating(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """The rating struct as two columns; NULL where the struct, or the column, is missing."""
    if roles.rating not in df.columns:
        return df.withColumns(
            {
                "rating_rate": F.lit(None).cast("double"),
                "rating_count": F.lit(None).cast("int"),
            }
        )
    fields = df.schema[roles.rating].dataType
    rate, count = (F.col(roles.rating)[name] for name in (roles.rate_field, roles.count_field))
    return df.withColumns(
        {
            "rating_rate": to_double(rate, text=is_text(fields[roles.rate_field].dataType)),
            "rating_count": to_whole_number(count, text=is_text(fields[roles.count_field].dataType)),
        }
    ).drop(roles.rating)


def conform(taken: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Types, text and flags for rows that passed the checks; still several rows per key."""
    if KEY not in taken.columns:
        taken = taken.withColumns({KEY: typed_key(taken, roles), PRICE: typed_price(taken, roles)})
    text = {
        roles.title: normalized(F.col(roles.title)),
        roles.category: normalized(F.col(roles.category), fold_case=True),
    }
    if roles.description in taken.columns:
        text[roles.description] = normalized(F.col(roles.description))
    typed = taken.withColumns({roles.key: F.col(KEY), roles.price: F.col(PRICE), **text}).drop(
        CORRUPT, KEY, PRICE
    )
    flat = flatten_rating(typed, roles)
    flat = flat.withColumns(
        {
            "has_rating": has_rating(F.col("rating_rate")),
            "is_valid": is_valid(F.col(roles.price), F.col(roles.title)),
        }
    )
    first = [name for name in SILVER.names if name in flat.columns]
    rest = [f"`{name}`" for name in flat.columns if name not in first]
    return flat.select(*first, *rest)


def deduplicated(conformed: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """The newest row of each key by its ingestion instant, valid or not."""
    newest = instant(conformed, roles.ingested_at).desc()
    return latest_per_key(conformed, roles.key, [newest])


def clean(bronze: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Bronze rows to silver rows: check, conform, deduplicate, stamp."""
    taken = usable(bronze, roles)
    return stamp_silver(deduplicated(conform(taken, roles), roles))


def stamp_silver(df: DataFrame) -> DataFrame:
    return df.withColumn(LOADED_AT, F.current_timestamp())


def write_silver(
    silver: DataFrame,
    path: str,
    *,
    roles: Roles = DEFAULT_ROLES,
    fmt: str = "parquet",
    swap: bool = True,
    arranged: bool = False,
) -> int:
    """Replace the silver table, one folder per category; return its number of rows.

    Deduplication leaves the rows spread by key, so each task would open a file in each
    category. The rebalance brings a category's rows together, and AQE splits a
    category that is too large for one task and joins those that are too small.
    ``arranged`` leaves it out, for rows that lie together by category already.
    """
    seen = Observation()
    rows = silver if arranged else together_by(silver, roles.category)
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    publish(rows, path, partition_by=roles.category, fmt=fmt, swap=swap)
    return seen.get["rows"]


def replace_files(
    rows: DataFrame,
    path: str,
    old: Mapping[str, str],
    roles: Roles = DEFAULT_ROLES,
    *,
    arranged: bool = False,
) -> None:
    """Add ``rows`` to the table and remove the files they replace; leave all others.

    ``old`` gives the place of each file by its folder and name. ``rows`` may read those files: they
    are removed once the new ones are committed. A run that dies in between leaves no key out, but
    a key may stand in an old and a new file.
    """
    spark = rows.sparkSession
    (rows if arranged else together_by(rows, roles.category)).write.mode("append").partitionBy(roles.category).parquet(path)
    for place in old.values():
        drop_table(spark, place)
    for folder in {place.rpartition("/")[0] for place in old.values()}:
        if not has_files(spark, folder):
            drop_table(spark, folder)


@dataclass(frozen=True)
class SilverRun:
    rejected: int
    rows: int


def refine(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    rejects_path: str,
    *,
    roles: Roles = DEFAULT_ROLES,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    swap: bool = True,
    allow_empty: bool = False,
) -> SilverRun:
    """Build the silver table and the table of rejects from bronze.

    If every row is refused, a silver table that stands already is not replaced by an empty one:
    the run fails, unless ``allow_empty`` is set. The files of a wrong layout look like that.

    The silver pass counts the rejects on its way. Only if there are any is bronze
    scanned again to write them; a task repeated after a lost executor can raise that
    count but not hide a reject, so the number returned is taken from the rejects written.
    """
    labelled = checked(read_bronze(spark, bronze_path, schema=schema, fmt=fmt), roles)
    refused = Observation()
    watched = labelled.observe(refused, F.count_if(F.col(REASON).isNotNull()).alias("rows"))
    silver = stamp_silver(deduplicated(conform(accepted(watched), roles), roles))
    if not allow_empty and table_exists(spark, silver_path):
        if accepted(labelled).isEmpty() and not labelled.isEmpty():
            raise ValueError("no row of bronze is usable; the silver table is left as it is")
    rows = write_silver(silver, silver_path, roles=roles, fmt=fmt, swap=swap)
    bad = rejected(labelled)
    if refused.get["rows"] == 0:
        bad = spark.createDataFrame([], bad.schema)
    written = Observation()
    publish(bad.observe(written, F.count(F.lit(1)).alias("rows")), rejects_path, fmt=fmt, swap=swap)
    return SilverRun(rejected=written.get["rows"], rows=rows)
