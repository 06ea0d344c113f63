"""Where tables live: existence checks, safe replacement, shared scratch space.

All paths are URIs for Hadoop's FileSystem, so the same code serves local disks,
HDFS and object stores.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F


def _file_system(spark: SparkSession, uri: str):
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def table_exists(spark: SparkSession, uri: str) -> bool:
    fs, path = _file_system(spark, uri)
    return fs.exists(path)


def stored_bytes(spark: SparkSession, uri: str) -> int:
    """Size of the files below ``uri``."""
    fs, path = _file_system(spark, uri)
    return fs.getContentSummary(path).getLength()


def _move(spark: SparkSession, source: str, destination: str) -> None:
    fs, path = _file_system(spark, source)
    if not fs.rename(path, _file_system(spark, destination)[1]):
        raise OSError(f"could not rename {source} to {destination}")


def _drop(spark: SparkSession, uri: str) -> None:
    fs, path = _file_system(spark, uri)
    fs.delete(path, True)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder for tables that a later step reads back.

    It lies in the folder that ``spark.checkpoint.dir`` names, or that
    ``setCheckpointDir`` chose, which every executor can reach. A session without one is
    refused: a folder of one machine would lose what other executors write. Whoever
    names the folder clears it; nothing in the library does.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def on_one_machine(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def name_scratch_locally(spark: SparkSession) -> None:
    """For test and trial sessions: where none is named, take a temporary folder as the shared one.

    Only a session whose executors all run in its own process shares such a folder; any other is
    left as it is, and :func:`shared_dir` then refuses it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and on_one_machine(spark):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))


def together_by(df: DataFrame, column: str) -> DataFrame:
    """Bring rows with equal ``column`` together for a write, without one task for a hot value.

    AQE splits what is too large and joins what is too small. In a session without it,
    each task that reads the rows writes those of one value on its own.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return df.hint("rebalance", column)
    return df.repartition(F.col(column), F.spark_partition_id())


def publish(
    df: DataFrame,
    uri: str,
    *,
    partition_by: str | None = None,
    fmt: str = "parquet",
    swap: bool = True,
) -> None:
    """Replace the table at ``uri`` with ``df``, which may read that same table.

    The new table is written beside the old one and put in its place by two renames, so
    a failed write leaves the old table whole. The renames are not one atomic step
    for readers; :func:`recover` repairs a run that died between them.
    On stores where a rename copies, pass ``swap=False`` (``df`` must then not read ``uri``)
    or use a table format with its own commit, such as ``fmt="delta"`` where installed.
    """
    spark = df.sparkSession
    uri = uri.rstrip("/")
    if fmt == "delta":
        _writer(df, fmt, partition_by).option("overwriteSchema", "true").save(uri)
        return
    if not swap:
        _writer(df, fmt, partition_by).save(uri)
        return
    recover(spark, uri)
    # Of its own for each run: two runs at a time must not write into one folder.
    staged, retired = shared_side(uri, "staged"), f"{uri}__retired"
    _writer(df, fmt, partition_by).save(staged)
    if table_exists(spark, uri):
        _drop(spark, retired)
        _move(spark, uri, retired)
    _move(spark, staged, uri)
    _drop(spark, retired)


def shared_side(uri: str, name: str) -> str:
    """A folder beside a table, of its own for each call."""
    return f"{uri.rstrip('/')}__{name}-{uuid.uuid4().hex}"


def has_files(spark: SparkSession, folder: str) -> bool:
    """Whether any file of a table lies in the folder."""
    fs, path = _file_system(spark, folder)
    names = (status.getPath().getName() for status in fs.listStatus(path))
    return any(not name.startswith((".", "_")) for name in names)


def folders_of(spark: SparkSession, folder: str) -> list[str]:
    """The names of the folders directly below ``folder``, which may be missing."""
    fs, path = _file_system(spark, folder)
    if not fs.exists(path):
        return []
    return [status.getPath().getName() for status in fs.listStatus(path) if status.isDirectory()]


def numbered(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """The numbers of the folders that are named by ``prefix`` and a number."""
    return sorted(int(name.removeprefix(prefix)) for name in folders_of(spark, folder) if name.startswith(prefix))


def file_sizes(spark: SparkSession, places: Iterable[str]) -> dict[str, int]:
    """Bytes of each of the files."""
    sizes = {}
    for place in places:
        fs, path = _file_system(spark, place)
        sizes[place] = fs.getFileStatus(path).getLen()
    return sizes


def set_mark(spark: SparkSession, uri: str) -> None:
    """Leave an empty folder that says that a change of the table beside it has begun."""
    fs, path = _file_system(spark, uri)
    fs.mkdirs(path)


def drop_table(spark: SparkSession, uri: str) -> None:
    """Remove a table of intermediate rows."""
    _drop(spark, uri)


def streamed(spark: SparkSession, uri: str) -> bool:
    """Whether a stream writes the table: readers then see only the files in its log."""
    return table_exists(spark, f"{uri.rstrip('/')}/_spark_metadata")


def recover(spark: SparkSession, uri: str) -> bool:
    """Put back the old table if a run ended between the renames of :func:`publish`."""
    uri = uri.rstrip("/")
    retired = f"{uri}__retired"
    if table_exists(spark, uri) or not table_exists(spark, retired):
        return False
    _move(spark, retired, uri)
    return True


def _writer(df: DataFrame, fmt: str, partition_by: str | None):
    writer = df.write.format(fmt).mode("overwrite")
    return writer.partitionBy(partition_by) if partition_by else writer
