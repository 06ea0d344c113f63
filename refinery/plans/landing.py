"""Landing: stamp a batch of records and append it to the raw zone by UTC date."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, functions as F

from refinery.functions import utc_date, utc_stamp
from refinery.storage import together_by

STAMP = "_ingested_at"
LANDED_ON = "ingest_date"


def stamped(records: DataFrame, moment: datetime | None = None) -> DataFrame:
    """Add the batch's stamp and the landing date; both come from one reading of the clock."""
    text = utc_stamp(moment)
    return records.withColumns({STAMP: F.lit(text), LANDED_ON: F.lit(text[:10])})


def land_records(
    records: DataFrame,
    base: str,
    *,
    moment: datetime | None = None,
    keep_stamp: bool = False,
) -> int:
    """Append the records as JSON Lines under ``ingest_date=`` folders; return their number.

    Raises ``ValueError`` for an empty batch. ``keep_stamp`` is for records that carry
    ``_ingested_at`` (and perhaps ``ingest_date``) already. One batch stamp means one folder, and every
    task writes its own file there. Stamps per row may mean many folders: the rows are then
    brought together by date first, and AQE splits a date that is too large for one task.
    """
    if keep_stamp:
        batch = records
        if LANDED_ON not in batch.columns:
            batch = batch.withColumn(LANDED_ON, utc_date(batch, STAMP))
        batch = together_by(batch, LANDED_ON)
    else:
        batch = stamped(records, moment)
    seen = Observation()
    (
        batch.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("append")
        .partitionBy(LANDED_ON)
        .json(base)
    )
    rows = seen.get["rows"]
    if rows == 0:
        raise ValueError("the batch holds no records")
    return rows
