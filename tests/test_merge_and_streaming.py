import json
import os
import shutil

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from records import DAY1, DAY2, T1, T2, by_key, record, write_array, write_lines, write_text
from refinery.contracts import BRONZE, RAW
from refinery.operators import late_arrivals, merge_unique, upsert
from refinery.plans import clean, file_index, write_bronze
from refinery.sources import read_bronze, read_raw, read_silver
from refinery.streaming import ingest_new_files, merge_new_rows
from refinery.streaming.incremental import merge_batch

SCHEMA = "k int, at int, v string"


def state(df):
    return {r.k: (r.at, r.v) for r in by_key(df, "k").values()}


BOTH = pytest.mark.parametrize("merge", [upsert, merge_unique])


@BOTH
def test_newer_replaces_older_does_not_new_is_added(spark, merge):
    target = spark.createDataFrame([(1, 5, "t"), (2, 5, "t"), (3, 5, "t")], SCHEMA)
    changes = spark.createDataFrame([(1, 6, "c"), (2, 4, "c"), (9, 1, "c")], SCHEMA)
    merged = merge(target, changes, "k", "at")
    assert state(merged) == {1: (6, "c"), 2: (5, "t"), 3: (5, "t"), 9: (1, "c")}
    assert state(merge(merged, changes, "k", "at")) == state(merged)


@BOTH
def test_columns_of_either_side_are_kept(spark, merge):
    target = spark.createDataFrame([(1, 5, "t")], SCHEMA)
    changes = spark.createDataFrame([(1, 6, 7), (2, 6, 8)], "k int, at int, extra int")
    rows = by_key(merge(target, changes, "k", "at"), "k")
    assert rows[1].v is None and rows[1].extra == 7 and rows[2].extra == 8


@BOTH
def test_null_order_values_lose(spark, merge):
    target = spark.createDataFrame([(1, None, "t"), (2, 1, "t")], SCHEMA)
    changes = spark.createDataFrame([(1, 0, "c"), (2, None, "c")], SCHEMA)
    assert state(merge(target, changes, "k", "at")) == {1: (0, "c"), 2: (1, "t")}


ROWS = st.dictionaries(
    st.integers(0, 8), st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.sampled_from("xyz")), max_size=8
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=ROWS, right=ROWS)
def test_both_ways_agree_with_brute_force(spark, left, right):
    frames = [
        spark.createDataFrame([(k, at, v) for k, (at, v) in side.items()], SCHEMA) for side in (left, right)
    ]
    rank = lambda row: (row[0] is not None, row[0] or 0, row[1])
    expected = {
        k: max((side[k] for side in (left, right) if k in side), key=rank) for k in {*left, *right}
    }
    assert state(upsert(*frames, "k", "at")) == expected
    assert state(merge_unique(*frames, "k", "at")) == expected


def test_late_arrivals(spark, root):
    write_lines(root, DAY1, "a.json", [record(1, at=T1)])
    write_lines(root, "2026-05-12", "late.json", [record(1, "late", at=T1), record(2, at="2026-05-12T00:00:00+00:00")])
    raw = read_raw(spark, root, schema=RAW)
    [late] = late_arrivals(raw).collect()
    assert (late.title, late.days_late) == ("late", 4)
    assert late_arrivals(raw, allowed_days=4).count() == 0


def test_a_late_file_does_not_change_the_target(spark, root):
    write_lines(root + "/1", DAY2, "a.json", [record(1, "now", at=T2)])
    write_lines(root + "/2", "2026-05-12", "late.json", [record(1, "late", at=T1)])
    target, change = (clean(read_raw(spark, f"{root}/{n}", schema=RAW)) for n in (1, 2))
    for merge in (upsert, merge_unique):
        assert by_key(merge(target, change, "id", "_ingested_at"))[1].title == "now"


def ingest(spark, root, **more):
    ingest_new_files(spark, root + "/raw", root + "/bronze", root + "/state", **more).awaitTermination()
    return sorted(r.id for r in read_bronze(spark, root + "/bronze").collect() if r.id)


@pytest.mark.parametrize("max_files", [None, 1])
def test_only_new_files_are_loaded(spark, root, max_files):
    write_lines(root + "/raw", DAY1, "a.json", [record(1), record(2)])
    write_lines(root + "/raw", DAY1, "b.json", [record(3)])
    assert ingest(spark, root, max_files=max_files) == ["1", "2", "3"]
    assert ingest(spark, root, max_files=max_files) == ["1", "2", "3"]
    write_lines(root + "/raw", DAY2, "c.json", [record(4)])
    assert ingest(spark, root, max_files=max_files) == ["1", "2", "3", "4"]


@pytest.mark.parametrize("broadcast_bytes", [10**7, 0])
def test_incremental_silver_equals_a_full_rebuild(spark, root, broadcast_bytes):
    def load():
        ingest(spark, root)
        merge_new_rows(
            spark, root + "/bronze", root + "/silver", root + "/rejects", root + "/merge_state",
            schema=BRONZE, broadcast_bytes=broadcast_bytes,
        ).awaitTermination()
        stored = read_silver(spark, root + "/silver").drop("_silver_loaded_at")
        full = clean(read_bronze(spark, root + "/bronze")).drop("_silver_loaded_at")
        assert sorted(map(str, stored.collect())) == sorted(map(str, full.collect()))
        return {r.id: (r.title, r.category) for r in stored.collect()}

    write_lines(root + "/raw", DAY1, "a.json", [record(1, "old"), record(2), record("x")])
    assert load() == {1: ("old", "tools"), 2: ("Item", "tools")}
    write_lines(root + "/raw", DAY2, "b.json", [record(1, "new", category="moved", at=T2), record(3, price="n/a")])
    assert load()[1] == ("new", "moved")
    write_lines(root + "/raw", "2026-05-12", "late.json", [record(1, "late", at=T1), record(5, "added")])
    assert load() == {1: ("new", "moved"), 2: ("Item", "tools"), 5: ("added", "tools")}
    rejects = spark.read.parquet(root + "/rejects").collect()
    assert sorted(r._reject_reason for r in rejects) == ["type:id", "type:price"]


def test_corrupt_line_reaches_incremental_rejects(spark, root):
    write_text(root + "/raw", DAY1, "a.json", '{"id": 1\n')
    ingest_new_files(spark, root + "/raw", root + "/bronze", root + "/state").awaitTermination()
    [row] = read_bronze(spark, root + "/bronze").collect()
    assert row._corrupt_record == '{"id": 1'


@pytest.mark.parametrize("first", [[record("x"), record(None)], [record(1)]])
def test_a_batch_of_rejects_only(spark, root, first):
    def load():
        ingest(spark, root)
        merge_new_rows(
            spark, root + "/bronze", root + "/silver", root + "/rejects", root + "/merge_state", schema=BRONZE
        ).awaitTermination()

    write_lines(root + "/raw", DAY1, "a.json", first)
    load()
    write_lines(root + "/raw", DAY2, "b.json", [record("y"), record(2, price="free")])
    load()
    bad = [r for r in first if r["id"] != 1]
    assert spark.read.parquet(root + "/rejects").count() == len(bad) + 2
    assert read_silver(spark, root + "/silver").count() == len(first) - len(bad)
    write_lines(root + "/raw", "2026-05-10", "c.json", [record(7)])
    load()
    assert {r.id for r in read_silver(spark, root + "/silver").collect()} == {7} | {r["id"] for r in first} - {"x", None}


def test_a_repeated_batch_changes_nothing(spark, root):
    """A run that died after the swap is repeated under the same batch id."""
    write_lines(root + "/1", DAY1, "a.json", [record(1, "old"), record(2)])
    write_lines(root + "/2", DAY2, "b.json", [record(1, "new", at=T2), record(3), record("x")])
    first, second = (read_raw(spark, f"{root}/{n}", schema=RAW) for n in (1, 2))

    def state_after(batch, batch_id):
        merge_batch(batch, batch_id, root + "/silver", root + "/rejects")
        silver = read_silver(spark, root + "/silver").drop("_silver_loaded_at", "_bronze_loaded_at")
        return sorted(map(str, silver.collect()))

    state_after(first, 0)
    once = state_after(second, 1)
    assert state_after(second, 1) == once and len(once) == 3
    assert state_after(first, 0) == once
    assert spark.read.parquet(root + "/rejects").count() == 1


def merged(spark, root, **more):
    merge_new_rows(
        spark, root + "/bronze", root + "/silver", root + "/rejects", root + "/merge_state", schema=BRONZE, **more
    ).awaitTermination()
    return by_key(read_silver(spark, root + "/silver"))


def files_of(root, category):
    return sorted(n for n in os.listdir(f"{root}/silver/category={category}") if n.endswith(".parquet"))


def test_files_much_older_than_those_loaded_come_in(spark, root):
    write_lines(root + "/raw", DAY2, "new.json", [record(1)])
    ingest(spark, root)
    merged(spark, root)
    write_lines(root + "/raw", DAY1, "old.json", [record(2)])
    month_ago = os.path.getmtime(f"{root}/raw/ingest_date={DAY2}/new.json") - 30 * 86400
    os.utime(f"{root}/raw/ingest_date={DAY1}/old.json", (month_ago, month_ago))
    assert ingest(spark, root) == ["1", "2"]
    [file] = [n for n in os.listdir(root + "/bronze") if n.endswith(".parquet")][-1:]
    os.utime(f"{root}/bronze/{file}", (month_ago, month_ago))
    assert set(merged(spark, root)) == {1, 2}
    write_lines(root + "/raw", DAY2, "newer.json", [record(3)])
    assert ingest(spark, root) == ["1", "2", "3"] and set(merged(spark, root)) == {1, 2, 3}


def test_a_streamed_bronze_is_refused_by_the_batch_writer(spark, root):
    write_lines(root + "/raw", DAY1, "a.json", [record(1)])
    ingest(spark, root)
    for mode in ("append", "overwrite"):
        with pytest.raises(ValueError, match="stream"):
            write_bronze(spark.range(3).toDF("id"), root + "/bronze", mode=mode)
    assert ingest(spark, root) == ["1"]


def test_a_batch_bronze_is_refused_by_the_stream(spark, root):
    write_lines(root + "/raw", DAY1, "a.json", [record(1)])
    write_bronze(read_raw(spark, root + "/raw", schema=RAW), root + "/bronze")
    with pytest.raises(ValueError, match="write_bronze"):
        ingest(spark, root)
    assert read_bronze(spark, root + "/bronze").count() == 1


@pytest.mark.parametrize("layout, write", [("lines", write_lines), ("array", write_array)])
def test_unnamed_fields_are_rescued(spark, root, layout, write):
    rows = [record(1, stock=5, rating=(4, 2)), record(2, rating=(1, 1)), {**record(3), "rating": {"rate": 1, "source": "x"}}]
    write(root + "/raw", DAY1, "a.json", rows)
    write_text(root + "/raw", DAY1, "b.json", '\n{"id": 4\n' if layout == "lines" else '{"id": 4\n')
    ingest(spark, root, rescue=True, layout=layout)
    found = {r.id: r for r in read_bronze(spark, root + "/bronze").collect()}
    assert len(found) == 4 and found[None]._corrupt_record.startswith('{"id": 4')
    assert found["2"]._rescued is None and found["2"].rating["count"] == "1"
    assert json.loads(found["1"]._rescued) == {"stock": "5"}
    assert json.loads(json.loads(found["3"]._rescued)["rating"])["source"] == "x"


@pytest.mark.parametrize("few_files", [0, file_index.FEW_FILES])
def test_only_the_touched_categories_are_written(spark, root, monkeypatch, few_files):
    """With the index, and without it, as in a table of few files."""
    monkeypatch.setattr(file_index, "FEW_FILES", few_files)
    first = [record(n, category=c) for n, c in enumerate(["a", "a", "b", "c", "Ü x/y", ""])]
    write_lines(root + "/raw", DAY1, "a.json", first)
    ingest(spark, root)
    merged(spark, root)
    untouched = files_of(root, "a")
    write_lines(root + "/raw", DAY2, "b.json", [record(2, "moved", category="c", at=T2), record(4, "new", category="ü x/y", at=T2)])
    ingest(spark, root)
    found = merged(spark, root)
    assert {k: (r.title, r.category) for k, r in found.items()} == {
        0: ("Item", "a"), 1: ("Item", "a"), 2: ("moved", "c"), 3: ("Item", "c"), 4: ("new", "ü x/y"), 5: ("Item", "")}
    assert files_of(root, "a") == untouched
    assert not os.path.exists(root + "/silver/category=b")
    beside = ["silver"] if few_files else ["silver", "silver__index"]
    assert sorted(n for n in os.listdir(root) if n.startswith("silver")) == beside


@pytest.mark.parametrize("broadcast_bytes", [10**7, 0])
def test_merge_reads_only_the_touched_categories(spark, root, broadcast_bytes):
    write_lines(root + "/raw", DAY1, "a.json", [record(n, category="abc"[n % 3]) for n in range(9)])
    ingest(spark, root)
    merged(spark, root)
    kept = {c: files_of(root, c) for c in "bc"}
    write_lines(root + "/raw", DAY2, "b.json", [record(0, "x", category="a", at=T2), record(99, category="d")])
    ingest(spark, root)
    assert len(merged(spark, root, broadcast_bytes=broadcast_bytes)) == 10
    assert {c: files_of(root, c) for c in "bc"} == kept


def test_a_run_that_died_between_folders_is_mended(spark, root):
    write_lines(root + "/raw", DAY1, "a.json", [record(1, category="a"), record(2, category="b")])
    ingest(spark, root)
    merged(spark, root)
    shutil.copytree(root + "/silver/category=b", root + "/old")
    write_lines(root + "/raw", DAY2, "b.json", [record(2, "moved", category="a", at=T2)])
    ingest(spark, root)
    assert merged(spark, root)[2].category == "a" and not os.path.exists(root + "/silver__merging")
    # As if the run had ended before it removed the emptied folder.
    shutil.copytree(root + "/old", root + "/silver/category=b")
    os.mkdir(root + "/silver__merging")
    write_lines(root + "/raw", DAY2, "c.json", [record(3, category="c", at=T2)])
    ingest(spark, root)
    found = merged(spark, root)
    assert {k: (r.title, r.category) for k, r in found.items()} == {1: ("Item", "a"), 2: ("moved", "a"), 3: ("Item", "c")}
    assert not os.path.exists(root + "/silver__merging")
