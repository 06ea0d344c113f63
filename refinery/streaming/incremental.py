"""Incremental loads: new raw files into bronze, new bronze rows into silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from refinery.contracts import BRONZE, RAW
from refinery.operators.merge import merge_unique, upsert
from refinery.operators.rejects import REASON, accepted, checked, rejected
from refinery.plans.file_index import FileIndex
from refinery.plans.gold_state import forget, write_feed
from refinery.plans.silver import (
    conform,
    deduplicated,
    replace_files,
    stamp_silver,
    write_silver,
)
from refinery.roles import DEFAULT_ROLES, Roles
from refinery.sources.raw_json import RESCUED, parse_records, shape_raw, text_scan, with_corrupt
from refinery.sources.tables import FILE, read_silver
from refinery.storage import (
    drop_table,
    recover,
    set_mark,
    shared_side,
    streamed,
    table_exists,
    together_by,
)

# In memory: rows times the width of a row.
BROADCAST_BYTES = 64 * 1024 * 1024
# A file older than this, counted from the newest one seen, would be left out without a message.
# Spark's own default is seven days; late files have to come in whenever they arrive.
MAX_FILE_AGE = "36500d"


def ingest_new_files(
    spark: SparkSession,
    raw_path: str,
    bronze_path: str,
    checkpoint: str,
    *,
    schema: T.StructType = RAW,
    layout: str = "lines",
    max_files: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
    rescue: bool = False,
) -> StreamingQuery:
    """Append the raw files that no earlier call has loaded, each exactly once, then stop.

    The file sink's log makes a batch visible as a whole or not at all, so a restart after a failure
    neither loses nor repeats rows. A stream needs a fixed schema; with ``rescue`` the fields that
    ``schema`` does not name are kept as one JSON text in ``_rescued``. ``max_files`` bounds one batch.

    ``max_file_age`` keeps late files: the source remembers all files it has seen within it, so its
    log grows with their number. A shorter age is for raw zones whose old folders get no more files.
    """
    if table_exists(spark, bronze_path) and not streamed(spark, bronze_path):
        raise ValueError(f"{bronze_path} was written by write_bronze; a stream cannot add to it")
    reader = spark.readStream.option("maxFileAge", max_file_age)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if rescue or layout != "lines":
        rows = parse_records(text_scan(reader, raw_path, layout), schema, layout)
        rows = rows if rescue else rows.drop(RESCUED)
    else:
        reader = reader.schema(with_corrupt(schema)).option("columnNameOfCorruptRecord", "_corrupt_record")
        rows = shape_raw(reader.option("recursiveFileLookup", True).json(raw_path))
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", bronze_path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def merge_new_rows(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    rejects_path: str,
    checkpoint: str,
    *,
    schema: T.StructType = BRONZE,
    roles: Roles = DEFAULT_ROLES,
    max_files: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
    broadcast_bytes: int = BROADCAST_BYTES,
    gold_state: str | None = None,
) -> StreamingQuery:
    """Upsert the bronze rows that no earlier call has seen into silver, then stop.

    A batch that is repeated after a failure changes nothing: the merge keeps the
    newest row per key, and each batch's rejects have a folder of their own. Plain Parquet
    has no update in place, so a batch rewrites the files that hold its keys; leave ``max_files``
    unset to take all that is new in one batch. With ``gold_state`` each batch leaves what it
    changed in the feed that :func:`refinery.plans.gold_state.refresh` takes up.
    """
    reader = spark.readStream.schema(schema).option("maxFileAge", max_file_age)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, silver_path, rejects_path, roles, broadcast_bytes, gold_state)

    return (
        reader.parquet(bronze_path)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def merge_batch(
    batch: DataFrame,
    batch_id: int,
    silver_path: str,
    rejects_path: str,
    roles: Roles = DEFAULT_ROLES,
    broadcast_bytes: int = BROADCAST_BYTES,
    gold_state: str | None = None,
) -> None:
    """Clean one batch and merge it into the silver table.

    The batch is read again only if it holds rejects. Only the files that hold a changed key are
    read whole and written again, found through the index beside the table; all others stay, also
    those of the same category. Changes of at most
    ``broadcast_bytes``, rows times row width, are broadcast, and the target's rows are
    not shuffled. Larger changes shuffle both sides by key, and the result is arranged by
    category again.
    """
    spark = batch.sparkSession
    labelled = checked(batch, roles)
    refused = Observation()
    watched = labelled.observe(refused, F.count_if(F.col(REASON).isNotNull()).alias("rows"))
    changes = stamp_silver(deduplicated(conform(accepted(watched), roles), roles))

    recover(spark, silver_path)
    if not table_exists(spark, silver_path):
        if gold_state:
            forget(spark, gold_state)
        write_silver(changes, silver_path, roles=roles)
    else:
        _merge_stored(changes, silver_path, roles, broadcast_bytes, gold_state, batch_id)

    if refused.get["rows"]:
        folder = f"{rejects_path.rstrip('/')}/batch_id={batch_id}"
        rejected(labelled).write.mode("overwrite").parquet(folder)


def _row_bytes(schema: T.StructType) -> int:
    """What Spark assumes a row of this schema to take in memory, texts by a fixed guess."""
    return 8 + sum(8 + (100 if f.dataType == T.StringType() else 16) for f in schema.fields)


def _merge_stored(
    changes: DataFrame, silver_path: str, roles: Roles, broadcast_bytes: int, gold_state: str | None, batch_id: int
) -> None:
    spark, category = changes.sparkSession, roles.category
    begun = f"{silver_path.rstrip('/')}__merging"
    # Cleaned once, into a table of its own: the merge reads the changes more than once.
    changes_path = shared_side(silver_path, "changes")
    seen = Observation()
    counted = together_by(changes, category).observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.parquet(changes_path)
    try:
        stored = spark.read.schema(changes.schema).parquet(changes_path)
        small = seen.get["rows"] * _row_bytes(changes.schema) <= broadcast_bytes
        target = read_silver(spark, silver_path, roles=roles)
        if table_exists(spark, begun):
            # An earlier run died while it replaced folders: a key that moved may stand in two.
            if gold_state:
                forget(spark, gold_state)
            whole = upsert(target, stored, roles.key, roles.ingested_at)
            write_silver(whole, silver_path, roles=roles)
            drop_table(spark, begun)
            return
        keys = F.broadcast(stored.select(roles.key)) if small else stored.select(roles.key)

        def leave_feed(rows: DataFrame) -> None:
            if gold_state:
                before = rows.join(keys, roles.key, "left_semi")
                after = merge_unique(before, stored, roles.key, roles.ingested_at, broadcast_changes=small)
                write_feed(before, after, gold_state, batch_id, roles)

        if not set(changes.columns) <= set(target.columns):
            # A new column: all files take part, as in a full rewrite.
            leave_feed(target)
            merged = merge_unique(target, stored, roles.key, roles.ingested_at, broadcast_changes=small)
            write_silver(merged, silver_path, roles=roles, arranged=small)
            return
        index = FileIndex(spark, silver_path, roles, target.schema)
        touched = {*index.holding(keys, seen.get["rows"]), *index.crowded(stored)}
        part = index.scan(sorted(touched)).drop(FILE)
        merged = merge_unique(part, stored, roles.key, roles.ingested_at, broadcast_changes=small)
        leave_feed(part)
        set_mark(spark, begun)
        replace_files(merged, silver_path, {name: index.places[name] for name in touched}, roles, arranged=small)
        drop_table(spark, begun)
    finally:
        drop_table(spark, changes_path)
