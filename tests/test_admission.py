from datetime import timedelta

from pyspark.sql import functions as F

from refinery.streaming.admission import admit_batch, read_accepted, read_aside, read_repeats

SCHEMA = "id bigint, _ingested_at string, note string, tags map<string,string>"


def frame(spark, rows):
    return spark.createDataFrame([(*r, None) for r in rows], SCHEMA)


def admit(spark, root, batch_id, rows):
    admit_batch(frame(spark, rows), batch_id, root, key=["id"], delay=timedelta(days=2))


def state(spark, root):
    schema = frame(spark, []).schema
    accepted = {(r.id, r.note) for r in read_accepted(spark, root, schema).collect()}
    aside = sorted((r._admission, r.id, r.note) for r in read_aside(spark, root, schema).collect())
    repeats = {r.id: r.copies for r in read_repeats(spark, root, schema, ["id"]).collect()}
    return accepted, aside, repeats


def test_batches_are_sorted_and_nothing_is_lost(spark, tmp_path):
    root = str(tmp_path / "admitted")
    first = [
        (1, "2026-05-10T00:00:00+00:00", "a"), (2, "2026-05-10T12:00:00+00:00", "b"),
        (2, "2026-05-10T11:00:00+00:00", "earlier"), (3, "2026-05-10T00:00:00+00:00", "z"),
        (3, "2026-05-10T00:00:00+00:00", "y"), (None, "2026-05-30T00:00:00+00:00", "n"), (9, "junk", "t"), (9, None, "u"),
    ]
    admit(spark, root, 0, first)
    # The watermark is 2026-05-08T12:00: a null key moves it as little as a null time does.
    second = [
        (1, "2026-05-10T00:00:00+00:00", "again"), (4, "2026-05-08T12:00:00+00:00", "at the watermark"),
        (5, "2026-05-08T11:59:59+00:00", "late"), (6, "2026-05-11T02:00:00+02:00", "new"),
        *[(7, "2026-05-11T00:00:00+00:00", "hot")] * 50, (1, "2026-05-01T00:00:00+00:00", "late and known"),
    ]
    admit(spark, root, 1, second)
    accepted = {(1, "a"), (2, "earlier"), (3, "y"), (4, "at the watermark"), (6, "new"), (7, "hot")}
    aside = [("late", 1, "late and known"), ("late", 5, "late"), ("no key", None, "n"), ("no time", 9, "t"), ("no time", 9, "u")]
    repeats = {1: 1, 2: 1, 3: 1, 7: 49}
    assert state(spark, root) == (accepted, aside, repeats)
    assert len(accepted) + len(aside) + sum(repeats.values()) == len(first) + len(second)
    admit(spark, root, 1, second)  # after a failure
    assert state(spark, root) == (accepted, aside, repeats)
    admit(spark, root, 2, [])
    admit(spark, root, 3, [(8, "2026-05-09T00:00:00+00:00", "still in time"), (6, "2026-05-11T00:00:00+00:00", "again")])
    found = state(spark, root)
    assert found == (accepted | {(8, "still in time")}, aside, repeats | {6: 1})


def test_an_old_key_is_not_read_for_ever(spark, tmp_path):
    root = str(tmp_path / "admitted")
    admit(spark, root, 0, [(1, "2026-05-01T00:00:00+00:00", "old")])
    admit(spark, root, 1, [(2, "2026-05-20T00:00:00+00:00", "far ahead")])
    admit(spark, root, 2, [(1, "2026-05-20T00:00:00+00:00", "accepted again")])
    assert state(spark, root)[0] == {(1, "old"), (2, "far ahead"), (1, "accepted again")}


def test_an_empty_first_batch(spark, tmp_path):
    root = str(tmp_path / "admitted")
    admit(spark, root, 0, [])
    assert state(spark, root) == (set(), [], {})
    admit(spark, root, 1, [(1, "2026-05-01T00:00:00+00:00", "x")])
    assert state(spark, root)[0] == {(1, "x")}


def test_a_hot_key_is_counted_before_the_shuffle(spark, tmp_path):
    hot = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("id"),
        F.lit("2026-05-01T00:00:00+00:00").alias("_ingested_at"), F.lit("x").alias("note"),
        F.lit(None).cast("map<string,string>").alias("tags"),
    )
    root = str(tmp_path / "admitted")
    admit_batch(hot, 0, root, key=["id"])
    assert read_accepted(spark, root, hot.schema).count() == hot.select("id").distinct().count()
    assert {r.id: r.copies for r in read_repeats(spark, root, hot.schema, ["id"]).collect()} == {1: 1667}
