"""Bronze: the raw records as they are, plus lineage, as a columnar table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from refinery.sources.tables import read_bronze
from refinery.storage import publish, recover, streamed, table_exists


@dataclass(frozen=True)
class Content:
    """What a table holds, whatever the order of its rows and columns: their number and their hashes' sums."""

    rows: int
    hash_sum: int
    hash_xor: int


def _content(df: DataFrame) -> list[Column]:
    # By name and not by place: a partition column comes last when it is read. Texts apart from
    # NULL, since a hash leaves NULLs out.
    named = [F.struct(F.lit(name), F.col(f"`{name}`").isNull(), F.col(f"`{name}`")) for name in sorted(df.columns)]
    code = F.xxhash64(*named)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(code.cast("decimal(20,0)")), F.lit(0)).cast("string").alias("hash_sum"),
        F.coalesce(F.bit_xor(code), F.lit(0)).alias("hash_xor"),
    ]


def content_of(df: DataFrame) -> Content:
    row = df.agg(*_content(df)).first()
    return Content(row.rows, int(row.hash_sum), row.hash_xor)


def write_watched(df: DataFrame, path: str, *, partition_by: str | None = None, swap: bool = True) -> Content:
    """Replace the table and return its content, taken while the rows pass by."""
    seen = Observation()
    publish(df.observe(seen, *_content(df)), path, partition_by=partition_by, swap=swap)
    return Content(seen.get["rows"], int(seen.get["hash_sum"]), seen.get["hash_xor"])


def verify_content(stored: DataFrame, expected: Content) -> Content:
    """Read the table again; fail if any cell differs from what was written."""
    found = content_of(stored)
    if found != expected:
        raise ValueError(f"the table holds {found}, {expected} was written")
    return found


def merge_schema(df: DataFrame, stored: T.StructType) -> DataFrame:
    """``df`` with the stored table's columns first; what either side lacks is NULL."""
    nothing = df.sparkSession.createDataFrame([], stored)
    return nothing.unionByName(df, allowMissingColumns=True)


def write_bronze(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    fmt: str = "parquet",
    swap: bool = True,
) -> int:
    """Write the table and return its number of rows, counted in the same pass.

    ``overwrite`` keeps the columns of the table it replaces and adds new ones;
    ``append`` adds files under the schema they have. A table that a stream writes is
    refused, since its readers would not see the rows.
    """
    spark = df.sparkSession
    if streamed(spark, path):
        raise ValueError(f"{path} is written by a stream; load it with ingest_new_files")
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode!r}")
    recover(spark, path)
    if mode == "overwrite" and fmt != "delta" and table_exists(spark, path):
        df = merge_schema(df, read_bronze(spark, path, fmt=fmt).schema)
    seen = Observation()
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if mode == "append" or fmt == "delta":
        df.write.format(fmt).mode(mode).option("mergeSchema", True).save(path)
    else:
        publish(df, path, fmt=fmt, swap=swap)
    return seen.get["rows"]


def verify_bronze(
    spark: SparkSession, path: str, expected: int, *, fmt: str = "parquet"
) -> int:
    """Count the stored rows, from file footers alone, and compare with what was written."""
    stored = read_bronze(spark, path, fmt=fmt).count()
    if stored != expected:
        raise ValueError(f"bronze holds {stored} rows, {expected} were written")
    return stored
