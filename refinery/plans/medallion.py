"""The whole chain, from records or landed files to gold and serving tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, types as T

from refinery.contracts import RAW, SERVING, bronze_schema
from refinery.plans.bronze import verify_bronze, write_bronze
from refinery.plans.compaction import compact_bronze
from refinery.plans.gold import category_kpis, price_buckets, top_products, write_gold
from refinery.plans.gold_state import refresh
from refinery.plans.landing import land_records
from refinery.plans.serving import export_tables
from refinery.plans.silver import SilverRun, refine
from refinery.roles import DEFAULT_ROLES, Roles
from refinery.sources.raw_json import RESCUED, read_raw, read_records
from refinery.sources.tables import read_silver
from refinery.streaming.incremental import MAX_FILE_AGE, ingest_new_files, merge_new_rows


@dataclass(frozen=True)
class Layout:
    """Where the layers lie below one root."""

    root: str

    def at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def raw(self) -> str:
        return self.at("raw")

    @property
    def bronze(self) -> str:
        return self.at("bronze")

    @property
    def silver(self) -> str:
        return self.at("silver")

    @property
    def rejects(self) -> str:
        return self.at("rejects")

    @property
    def gold(self) -> str:
        return self.at("gold")

    @property
    def serving(self) -> str:
        return self.at("serving")


@dataclass(frozen=True)
class Run:
    bronze: int
    silver: SilverRun
    exported: dict = field(default_factory=dict)


def load_bronze(
    spark: SparkSession,
    place: Layout,
    *,
    layout: str = "lines",
    schema: T.StructType | None = RAW,
    ingest_date: str | None = None,
    fmt: str = "parquet",
    swap: bool = True,
) -> int:
    """Raw files to the bronze table; ``schema=None`` discovers new fields in a pass of its own.

    Fields that ``schema`` does not name are kept as one JSON text in ``_rescued``.
    """
    if schema is None:
        raw = read_raw(spark, place.raw, layout=layout, ingest_date=ingest_date)
    else:
        raw = read_records(spark, place.raw, schema, layout=layout, ingest_date=ingest_date)
    return verify_bronze(spark, place.bronze, write_bronze(raw, place.bronze, fmt=fmt, swap=swap), fmt=fmt)


def build_gold(
    spark: SparkSession,
    place: Layout,
    roles: Roles = DEFAULT_ROLES,
    *,
    fmt: str = "parquet",
    swap: bool = True,
) -> None:
    """The three gold tables. Each reads only the silver columns it needs."""
    silver = read_silver(spark, place.silver, roles=roles, fmt=fmt)
    for build, table in (
        (category_kpis, "gold_category_kpis"),
        (top_products, "gold_top_products"),
        (price_buckets, "gold_price_buckets"),
    ):
        write_gold(build(silver, roles), place.gold, table, fmt=fmt, swap=swap)


def _export(
    spark: SparkSession,
    place: Layout,
    contracts: Mapping[str, T.StructType],
    jdbc_url: str | None,
    jdbc: Mapping[str, str] | None,
    fmt: str,
) -> dict[str, bool]:
    """To the database that ``jdbc_url`` names, or else to files below the root."""
    directory = None if jdbc_url else place.serving
    return export_tables(
        spark,
        place.gold,
        jdbc_url=jdbc_url,
        jdbc=jdbc,
        directory=directory,
        contracts=contracts,
        gold_fmt=fmt,
    )


def run(
    spark: SparkSession,
    root: str,
    *,
    records: DataFrame | None = None,
    moment: datetime | None = None,
    layout: str = "lines",
    schema: T.StructType | None = RAW,
    ingest_date: str | None = None,
    roles: Roles = DEFAULT_ROLES,
    export: bool = True,
    contracts: Mapping[str, T.StructType] = SERVING,
    jdbc_url: str | None = None,
    jdbc: Mapping[str, str] | None = None,
    fmt: str = "parquet",
    swap: bool = True,
    allow_empty: bool = False,
) -> Run:
    """Land ``records`` if given, then rebuild bronze, silver, gold and the serving tables.

    Each layer replaces its table, so a rerun gives the same tables. ``layout`` says how
    the raw files are written; landing writes ``"lines"``. Files of another layout give no usable
    row, and the run then fails before it touches silver, unless ``allow_empty`` is set.
    The raw files are read once, under ``schema``; with ``schema=None`` new fields are discovered first.
    ``ingest_date`` takes one landing day only. ``swap=False`` is for stores on which a rename copies.
    """
    place = Layout(root)
    if records is not None:
        land_records(records, place.raw, moment=moment)
    loaded = load_bronze(
        spark, place, layout=layout, schema=schema, ingest_date=ingest_date, fmt=fmt, swap=swap
    )
    silver = replay(spark, root, roles=roles, fmt=fmt, swap=swap, allow_empty=allow_empty)
    exported = _export(spark, place, contracts, jdbc_url, jdbc, fmt) if export else {}
    return Run(bronze=loaded, silver=silver, exported=exported)


def replay(
    spark: SparkSession,
    root: str,
    *,
    roles: Roles = DEFAULT_ROLES,
    fmt: str = "parquet",
    swap: bool = True,
    allow_empty: bool = False,
) -> SilverRun:
    """Rebuild silver and gold from the stored bronze table."""
    place = Layout(root)
    silver = refine(
        spark, place.bronze, place.silver, place.rejects,
        roles=roles, fmt=fmt, swap=swap, allow_empty=allow_empty,
    )
    build_gold(spark, place, roles, fmt=fmt, swap=swap)
    return silver


def run_new(
    spark: SparkSession,
    root: str,
    *,
    records: DataFrame | None = None,
    moment: datetime | None = None,
    layout: str = "lines",
    schema: T.StructType = RAW,
    roles: Roles = DEFAULT_ROLES,
    export: bool = True,
    contracts: Mapping[str, T.StructType] = SERVING,
    jdbc_url: str | None = None,
    jdbc: Mapping[str, str] | None = None,
    swap: bool = True,
    max_files: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
    compact: bool = False,
) -> dict[str, bool]:
    """The daily job: load only the raw files no earlier call has seen, and merge them.

    Use either this or :func:`run` on a root; each refuses a bronze table of the other. Fields that
    ``schema`` does not name reach bronze and silver as one JSON text in ``_rescued``. There is no
    landing day to choose: what is new is known from the files already loaded, whichever day they
    belong to. ``compact`` packs bronze's small files at the end. Gold follows what the merges changed and is not built again from all of silver.
    """
    place = Layout(root)
    if records is not None:
        land_records(records, place.raw, moment=moment)
    ingest_new_files(
        spark, place.raw, place.bronze, place.at("ingest_state"),
        schema=schema, layout=layout, max_files=max_files, max_file_age=max_file_age, rescue=True,
    ).awaitTermination()
    stored = T.StructType(bronze_schema(schema).fields + [T.StructField(RESCUED, T.StringType())])
    merge_new_rows(
        spark, place.bronze, place.silver, place.rejects, place.at("merge_state"),
        schema=stored, roles=roles, max_file_age=max_file_age, gold_state=place.at("gold_state"),
    ).awaitTermination()
    refresh(spark, place.silver, place.at("gold_state"), place.gold, roles, swap=swap)
    if compact:
        compact_bronze(spark, place.bronze, schema=stored)
    return _export(spark, place, contracts, jdbc_url, jdbc, "parquet") if export else {}
