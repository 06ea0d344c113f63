"""Scans of the bronze, silver and gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from refinery.contracts import SILVER, silver_schema_of
from refinery.roles import DEFAULT_ROLES, Roles
from refinery.sources.packed import current_files, packs_path, read_files, read_manifest, schema_of
from refinery.storage import table_exists

#: The column that :func:`read_silver` gives the file of a row in: its folder and name.
FILE = "__file"


def file_name(place: str) -> str:
    return "/".join(place.rsplit("/", 2)[-2:])


def read_bronze(
    spark: SparkSession,
    path: str,
    *,
    schema: T.StructType | None = None,
    merge_schema: bool = False,
    fmt: str = "parquet",
) -> DataFrame:
    """The bronze table.

    ``merge_schema`` is for a table that was appended to under different schemas: it opens
    every file's footer, so a large table is better read with an explicit ``schema``. Of a table that
    was compacted, the packed files stand for those that they cover.
    """
    if fmt == "parquet" and not merge_schema and table_exists(spark, packs_path(path)):
        manifest = read_manifest(spark, path)
        files = current_files(spark, path, manifest)
        return read_files(spark, files, schema or schema_of(spark, files, manifest))
    reader = spark.read.format(fmt).option("mergeSchema", merge_schema)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def silver_schema(
    spark: SparkSession, path: str, roles: Roles = DEFAULT_ROLES, fmt: str = "parquet"
) -> T.StructType:
    """The stored columns with the partition column as text, in the contract's order.

    A partitioned table without rows has no files to take a schema from: then the contract's,
    under the names and types of ``roles``.
    """
    try:
        fields = spark.read.format(fmt).load(path).schema.fields
    except AnalysisException as problem:
        if problem.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return silver_schema_of(roles)
    stored = {f.name: f for f in fields}
    stored[roles.category] = T.StructField(roles.category, T.StringType())
    first = [name for name in SILVER.names if name in stored]
    rest = [name for name in stored if name not in first]
    return T.StructType([stored[name] for name in first + rest])


def read_silver(
    spark: SparkSession,
    path: str,
    *,
    schema: T.StructType | None = None,
    roles: Roles = DEFAULT_ROLES,
    fmt: str = "parquet",
    files: Sequence[str] | None = None,
    with_file: bool = False,
) -> DataFrame:
    """The silver table with its category as text.

    Left to itself Spark turns directory names such as ``07`` into numbers, and an empty
    category into NULL. A filter on the restored column still prunes partitions. ``files`` reads
    some of the table's files only; ``with_file`` adds the file of each row.
    """
    schema = schema or silver_schema(spark, path, roles, fmt)
    reader = spark.read.format(fmt).schema(schema)
    stored = reader.load(path) if files is None else reader.option("basePath", path).load(list(files))
    names = [F.col(f"`{name}`") for name in schema.names]
    if with_file:
        names.append(F.substring_index("_metadata.file_path", "/", -2).alias(FILE))
    return stored.select(*names).withColumn(roles.category, F.coalesce(roles.category, F.lit("")))


def read_gold(spark: SparkSession, root: str, table: str, *, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(f"{root.rstrip('/')}/{table}")


def read_if_exists(
    spark: SparkSession, root: str, table: str, *, fmt: str = "parquet"
) -> DataFrame | None:
    """The gold table, or None where it was never written."""
    if not table_exists(spark, f"{root.rstrip('/')}/{table}"):
        return None
    return read_gold(spark, root, table, fmt=fmt)
