"""Late and repeated records of a stream: an event-time watermark whose drops are kept.

Spark's own watermark drops a late record without a trace. Here each batch is held against the
watermark that the batches before it left, the newest time they saw less ``delay``. Below ``root``

- ``accepted`` gets the first record of each key,
- ``aside`` gets whole records that are late, or have no time or no key, with the reason,
- ``repeats`` gets each key that came again, with the number of copies left out,
- ``marks`` gets the newest time of each batch.

The keyed state is the accepted table itself, of which a batch reads the keys of the days that are
not older than the watermark by more than ``delay``. Two records of a key are therefore found if their
times are within ``delay`` of each other; a later copy may be accepted again, as after Spark's own
``dropDuplicatesWithinWatermark``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from refinery.contracts import BRONZE
from refinery.functions import instant, sortable_values
from refinery.storage import drop_table, shared_side, table_exists, together_by
from refinery.streaming.incremental import MAX_FILE_AGE

BATCH, DAY, ADMISSION, COPIES = "_batch_id", "_day", "_admission", "copies"
LATE, NO_TIME, NO_KEY = "late", "no time", "no key"
_MICROS = "__micros"
_MARKS = T.StructType([T.StructField("newest", T.LongType()), T.StructField(BATCH, T.LongType())])


def _stored(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    path = f"{root.rstrip('/')}/{name}"
    if not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _with_batch(schema: T.StructType, *more: T.StructField) -> T.StructType:
    nullable = [T.StructField(f.name, f.dataType) for f in schema.fields]
    return T.StructType([*nullable, T.StructField(BATCH, T.LongType()), *more])


def read_accepted(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The first record of each key, with the columns of ``schema``."""
    whole = _with_batch(schema, T.StructField(DAY, T.DateType()))
    return _stored(spark, root, "accepted", whole).drop(BATCH, DAY)


def read_aside(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Records that were not admitted, with the reason in ``_admission``."""
    reasoned = T.StructType([*schema.fields, T.StructField(ADMISSION, T.StringType())])
    return _stored(spark, root, "aside", _with_batch(reasoned)).drop(BATCH)


def read_repeats(spark: SparkSession, root: str, schema: T.StructType, key: Sequence[str]) -> DataFrame:
    """The keys that came again, with the number of their copies that were left out."""
    counted = T.StructType([*[schema[name] for name in key], T.StructField(COPIES, T.LongType())])
    whole = _stored(spark, root, "repeats", _with_batch(counted))
    return whole.groupBy(*key).agg(F.sum(COPIES).alias(COPIES))


def admit_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    *,
    key: Sequence[str],
    at: str = "_ingested_at",
    delay: timedelta = timedelta(days=3),
) -> None:
    """Sort one batch into accepted, aside and repeats.

    A batch that is run again after a failure replaces what it wrote, and reads only earlier batches.
    Of equal keys in a batch the earliest is accepted, ties go to the least values. A record at the
    watermark is not late. One without time or with a null in its key is set aside. An empty batch
    leaves the watermark as it is. A key that a third of the batch shares is counted before the
    shuffle.
    """
    spark, root = batch.sparkSession, root.rstrip("/")
    wait = delay // timedelta(microseconds=1)
    marks = _stored(spark, root, "marks", _MARKS).filter(F.col(BATCH) < batch_id)
    newest = marks.agg(F.max("newest")).first()[0]
    watermark = None if newest is None else newest - wait

    micros = F.unix_micros(instant(batch, at).cast("timestamp"))
    no_key = F.greatest(*[F.col(f"`{name}`").isNull() for name in key], F.lit(False))
    late = F.lit(False) if watermark is None else F.col(_MICROS) < watermark
    reason = F.when(no_key, NO_KEY).when(F.col(_MICROS).isNull(), NO_TIME).when(late, LATE)
    labelled = batch.withColumn(_MICROS, micros).withColumn(ADMISSION, reason)

    seen = Observation()
    watched = labelled.observe(seen, F.max(F.when(~no_key, F.col(_MICROS))).alias("newest"))
    _write(watched.filter(F.col(ADMISSION).isNotNull()).drop(_MICROS), f"{root}/aside", batch_id)

    row = F.struct(*[F.col(f"`{name}`") for name in batch.columns])
    order = F.struct(F.col(_MICROS), *sortable_values(batch))
    firsts = (
        labelled.filter(F.col(ADMISSION).isNull())
        .groupBy(*[F.col(f"`{name}`") for name in key])
        .agg(F.count(F.lit(1)).alias(COPIES), F.min(_MICROS).alias(_MICROS), F.min_by(row, order).alias("row"))
    )
    if watermark is None:
        firsts = firsts.withColumn("known", F.lit(False))
    else:
        firsts = firsts.join(_known(batch, batch_id, root, key, at, watermark - wait), list(key), "left")
        firsts = firsts.withColumn("known", F.coalesce("known", F.lit(False)))
    held_at = shared_side(root, "admitting")
    firsts.write.parquet(held_at)
    try:
        held = spark.read.schema(firsts.schema).parquet(held_at)
        dated = held.filter(~F.col("known")).select("row.*", F.to_date(F.timestamp_micros(_MICROS)).alias(DAY))
        _write(together_by(dated, DAY), f"{root}/accepted", batch_id, DAY)
        left_out = (F.col(COPIES) - F.when(F.col("known"), 0).otherwise(1)).alias(COPIES)
        _write(held.select(*key, left_out).filter(F.col(COPIES) > 0), f"{root}/repeats", batch_id)
    finally:
        drop_table(spark, held_at)
    # Last: a batch without its mark is run again.
    _write(spark.createDataFrame([(seen.get["newest"],)], "newest bigint"), f"{root}/marks", batch_id)


def _known(batch: DataFrame, batch_id: int, root: str, key: Sequence[str], at: str, horizon: int) -> DataFrame:
    """The keys that earlier batches accepted, of times from ``horizon`` on."""
    whole = _with_batch(batch.schema, T.StructField(DAY, T.DateType()))
    stored = _stored(batch.sparkSession, root, "accepted", whole)
    # A day more: the session's time zone may have changed since.
    day = F.date_sub(F.to_date(F.timestamp_micros(F.lit(horizon))), 1)
    recent = stored.filter((F.col(BATCH) < batch_id) & (F.col(DAY) >= day))
    recent = recent.filter(F.unix_micros(instant(batch, at).cast("timestamp")) >= horizon)
    return recent.select(*key).distinct().withColumn("known", F.lit(True))


def _write(rows: DataFrame, path: str, batch_id: int, *partitions: str) -> None:
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(f"{path}/{BATCH}={batch_id}")


def admit_new_rows(
    spark: SparkSession,
    bronze_path: str,
    root: str,
    checkpoint: str,
    *,
    key: Sequence[str],
    schema: T.StructType = BRONZE,
    at: str = "_ingested_at",
    delay: timedelta = timedelta(days=3),
    max_files: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
) -> StreamingQuery:
    """Sort the bronze rows that no earlier call has seen, see :func:`admit_batch`, then stop."""
    reader = spark.readStream.schema(schema).option("maxFileAge", max_file_age)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def admit(batch: DataFrame, batch_id: int) -> None:
        admit_batch(batch, batch_id, root, key=key, at=at, delay=delay)

    return (
        reader.parquet(bronze_path)
        .writeStream.foreachBatch(admit)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
