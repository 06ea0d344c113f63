"""Serving: the gold tables, held to their contracts, written for other programs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession, types as T

from refinery.contracts import SERVING, enforce_contract
from refinery.sources.tables import read_if_exists


def jdbc_options(url: str, table: str, contract: T.StructType, **more: str) -> dict[str, str]:
    """Writer options that keep the declared types when a table is replaced."""
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString().upper()}"
        for f in contract.fields
        if isinstance(f.dataType, T.DecimalType)
    )
    return {
        "url": url,
        "dbtable": table,
        "truncate": "true",
        "createTableColumnTypes": columns,
        **more,
    }


def export_tables(
    spark: SparkSession,
    gold_root: str,
    *,
    jdbc_url: str | None = None,
    jdbc: Mapping[str, str] | None = None,
    directory: str | None = None,
    fmt: str = "parquet",
    contracts: Mapping[str, T.StructType] = SERVING,
    gold_fmt: str = "parquet",
) -> dict[str, bool]:
    """Replace each serving table, in a database or as files; report which gold tables existed.

    The executors write. Nothing is collected on the driver.
    """
    if (jdbc_url is None) == (directory is None):
        raise ValueError("name either a JDBC URL or a directory")
    exported = {}
    for table, contract in contracts.items():
        gold = read_if_exists(spark, gold_root, table, fmt=gold_fmt)
        exported[table] = gold is not None
        if gold is None:
            continue
        writer = enforce_contract(gold, contract).write.mode("overwrite")
        if jdbc_url is not None:
            writer.format("jdbc").options(
                **jdbc_options(jdbc_url, table, contract, **(jdbc or {}))
            ).save()
        else:
            writer.format(fmt).save(f"{directory.rstrip('/')}/{table}")
    return exported


def serve_views(
    spark: SparkSession,
    root: str,
    *,
    contracts: Mapping[str, T.StructType] = SERVING,
    fmt: str = "parquet",
) -> list[str]:
    """Make the tables stored below ``root`` temporary views, for reports in SQL."""
    served = []
    for table in contracts:
        stored = read_if_exists(spark, root, table, fmt=fmt)
        if stored is not None:
            stored.createOrReplaceTempView(table)
            served.append(table)
    return served
