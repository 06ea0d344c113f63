"""Tables that one step writes and later steps read, in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from refinery.storage import shared_dir


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder, with the writer's ``options``, and read it back.

    It cuts the lineage: a lost executor costs the tasks it ran, not the steps before.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
