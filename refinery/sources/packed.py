"""The packed files of a bronze table that a stream writes, and its manifests.

Beside the table lie folders of packed files and numbered manifests. The last manifest names the
packed files that stand now, and the stream's files whose rows they hold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, types as T

from refinery.storage import numbered, table_exists

_MANIFEST = "manifest="


@dataclass(frozen=True)
class Manifest:
    """Number, packed files by place, and the stream's files they stand for."""

    number: int
    packed: frozenset[str]
    covered: frozenset[str]


def packs_path(table: str) -> str:
    return f"{table.rstrip('/')}__packs"


def manifest_path(table: str, number: int) -> str:
    return f"{packs_path(table)}/{_MANIFEST}{number}"


def manifest_numbers(spark: SparkSession, table: str) -> list[int]:
    """The whole manifests: one that a run died over has no mark of success."""
    found = numbered(spark, packs_path(table), _MANIFEST)
    return [number for number in found if table_exists(spark, f"{manifest_path(table, number)}/_SUCCESS")]


def read_manifest(spark: SparkSession, table: str, number: int | None = None) -> Manifest:
    """The given manifest or the last one; an empty one where there is none. It has a row per file."""
    numbers = [number] if number is not None else manifest_numbers(spark, table)
    if not numbers:
        return Manifest(0, frozenset(), frozenset())
    rows = spark.read.schema("file string, covered boolean").parquet(manifest_path(table, numbers[-1])).collect()
    sides = [frozenset(row.file for row in rows if row.covered == covered) for covered in (False, True)]
    return Manifest(numbers[-1], *sides)


def files_of(table: DataFrame) -> list[str]:
    """The places of a scan's files, as any other scan takes them."""
    return [unquote(place) for place in table.inputFiles()]


def current_files(spark: SparkSession, table: str, manifest: Manifest) -> list[str]:
    """What a reader opens: the packed files, and those of the stream that they do not cover."""
    # The stream's log is listed; no file is opened for its schema, it may be gone.
    live = files_of(spark.read.schema("any string").parquet(table))
    return [*sorted(manifest.packed), *(place for place in live if place not in manifest.covered)]


def schema_of(spark: SparkSession, files: Sequence[str], manifest: Manifest) -> T.StructType:
    """The columns of a packed file, and those that only the newest file of the stream has."""
    live = [place for place in files if place not in manifest.packed]
    fields: dict[str, T.StructField] = {}
    for place in [*sorted(manifest.packed)[:1], *live[-1:]]:
        for field in spark.read.parquet(place).schema.fields:
            fields.setdefault(field.name, field)
    return T.StructType(list(fields.values()))


def read_files(spark: SparkSession, files: Sequence[str], schema: T.StructType, **options: str) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.options(**options).schema(schema).parquet(*files)
