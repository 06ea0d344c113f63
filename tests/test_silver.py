from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from records import DAY1, DAY2, T1, T2, by_key, record, write_array, write_text
from refinery import Roles
from refinery.contracts import RAW, SILVER
from refinery.operators import accepted, label_rejects, latest_per_key, rejected, require_fields, top_n_per_group
from refinery.plans import clean, refine, write_bronze, write_silver
from refinery.plans.silver import conform
from refinery.sources import read_raw, read_silver


def bronze(spark, root, rows, day=DAY1, name="a.json", schema=RAW):
    write_array(root + "/raw", day, name, rows)
    return read_raw(spark, root + "/raw", schema=schema, layout="array")


def test_newest_wins_and_unknown_fields_pass(spark, root):
    write_array(root + "/raw", DAY1, "a.json", [record(1, " Bag ", 109.95, " Men's Clothing", (3.9, 120))])
    newer = record(1, "Bag2", 110, "men's clothing", (4, 121), at=T2, stock=7)
    write_array(root + "/raw", DAY2, "b.json", [newer])
    row = by_key(clean(read_raw(spark, root + "/raw", layout="array")))[1]
    assert (row.title, row.price, row.category) == ("Bag2", Decimal("110.00"), "men's clothing")
    assert (row.rating_rate, row.rating_count, row.stock) == (4.0, 121, "7")
    assert row.has_rating and row.is_valid


def test_columns_follow_the_contract(spark, root):
    silver = clean(bronze(spark, root, [record(1, rating=(3.9, 120))]))
    assert silver.columns == SILVER.names
    assert [f.dataType for f in silver.schema] == [f.dataType for f in SILVER]


def test_text_rules(spark, root):
    rows = [record(1, "\tTab", category=" Mixed CASE "), record(2, "   "), record(3, category="  ")]
    silver = by_key(clean(bronze(spark, root, rows)))
    assert silver[1].title == "\tTab" and silver[1].category == "mixed case"
    assert silver[2].title == "" and silver[2].is_valid is False
    assert silver[3].category == ""


def test_missing_rating(spark, root):
    row = by_key(clean(bronze(spark, root, [record(2)])))[2]
    assert (row.rating_rate, row.rating_count, row.has_rating) == (None, None, False)


def test_rating_column_missing_altogether(spark):
    bronze_rows = spark.createDataFrame([("1", "t", "5", "c", T1)], "id string, title string, price string, category string, _ingested_at string")
    row = by_key(clean(bronze_rows))[1]
    assert row.rating_count is None and row.has_rating is False


def test_non_positive_prices_are_kept_but_invalid(spark, root):
    silver = by_key(clean(bronze(spark, root, [record(5, price=0), record(6, price=-1)])))
    assert [silver[k].is_valid for k in (5, 6)] == [False, False]


@pytest.mark.parametrize(
    "bad, reason",
    [
        (record(None), "required:id"),
        (record(3, title=None), "required:title"),
        (record(3, price=None), "required:price"),
        (record(3, category=None), "required:category"),
        (record("x9"), "type:id"),
        (record(3, price="n/a"), "type:price"),
        (record(3, price=1e12), "type:price"),
        (record(2**31), "type:id"),
        ({}, "required:id"),
    ],
)
def test_rejects_carry_their_reason(spark, root, bad, reason):
    labelled = label_rejects(bronze(spark, root, [bad, record(1)]))
    [row] = rejected(labelled).collect()
    assert row._reject_reason == reason
    assert [r.id for r in accepted(labelled).collect()] == ["1"]


def test_raw_text_of_a_reject_survives(spark, root):
    [row] = rejected(label_rejects(bronze(spark, root, [record("x9", price="n/a")]))).collect()
    assert (row.id, row.price) == ("x9", "n/a")


def test_corrupt_file_is_a_reject(spark, root):
    write_text(root + "/raw", DAY1, "bad.json", '[{"id": 9, ')
    labelled = label_rejects(bronze(spark, root, [record(1)]))
    [row] = rejected(labelled).collect()
    assert (row._reject_reason, row._corrupt_record) == ("corrupt", '[{"id": 9, ')


def test_lenient_numbers(spark, root):
    rows = [record(7.0), record(8, price=2.675), record(9, price=2.665, rating=("abc", 3.9))]
    silver = by_key(clean(bronze(spark, root, rows)))
    assert silver[7].id == 7
    assert (silver[8].price, silver[9].price) == (Decimal("2.68"), Decimal("2.67"))
    assert (silver[9].rating_rate, silver[9].rating_count, silver[9].has_rating) == (None, 3, False)


def test_inferred_numeric_bronze_is_taken_too(spark):
    rows = spark.createDataFrame(
        [(1, "t", 2.665, "c", (3.5, 4), T1), (2, "t", float("nan"), "c", None, T1)],
        "id bigint, title string, price double, category string, rating struct<rate:double,count:bigint>, _ingested_at string",
    )
    silver = by_key(clean(rows))
    assert set(silver) == {1} and silver[1].price == Decimal("2.67")
    [bad] = rejected(label_rejects(rows)).collect()
    assert bad._reject_reason == "required:price"


def test_wide_keys(spark, root):
    silver = clean(bronze(spark, root, [record(2**40 + 1)]), Roles(key_type="bigint"))
    assert [r.id for r in silver.collect()] == [2**40 + 1]


def test_newer_invalid_row_beats_older_valid_one(spark, root):
    rows = [record(1, price=5, at=T1), record(1, price=-5, at=T2)]
    row = by_key(clean(bronze(spark, root, rows)))[1]
    assert row.price == Decimal("-5.00") and row.is_valid is False


def test_unreadable_newer_row_does_not_displace_an_older_one(spark, root):
    rows = [record(1, price=5, at=T1), record(1, price="n/a", at=T2)]
    assert by_key(clean(bronze(spark, root, rows)))[1].price == Decimal("5.00")


def test_mixed_offsets_are_compared_as_instants(spark, root):
    early = record(1, "early", at="2026-05-08T12:00:00+05:00")  # 07:00 UTC
    late = record(1, "late", at="2026-05-08T08:00:00+00:00")
    assert by_key(clean(bronze(spark, root, [early, late])))[1].title == "late"


def test_ties_give_the_same_row_however_the_input_is_spread(spark, root):
    rows = [record(1, f"t{n}") for n in range(20)]
    raw = bronze(spark, root, rows)
    picked = {clean(raw.repartition(n)).collect()[0].title for n in (1, 3, 7)}
    assert picked == {"t9"}


def test_maps_take_part_in_tie_breaks(spark):
    df = spark.sql("select 1 id, 5 at, map('a', n) m from values (1), (2), (3) as t(n)")
    assert latest_per_key(df, "id", [F.desc("at")]).collect()[0].m == {"a": 3}


def test_top_n_per_group(spark):
    df = spark.range(100).selectExpr("id", "id % 4 as g")
    got = top_n_per_group(df, ["g"], [F.desc("id")], 2).collect()
    assert sorted((r.g, r.id) for r in got) == [(g, i) for g in range(4) for i in (92 + g, 96 + g)]


def test_require_fields_drops_null_and_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan")), (None, 2.0)], "a int, b double")
    assert [r.a for r in require_fields(df, ["a", "b"]).collect()] == [1]


def test_categories_survive_the_partitioned_table(spark, root):
    rows = [record(1, category="  "), record(2, category="07"), record(3, category="2024"), record(4, category="men's/x")]
    write_silver(clean(bronze(spark, root, rows)), root + "/silver")
    stored = read_silver(spark, root + "/silver")
    assert stored.columns == SILVER.names
    assert {r.id: r.category for r in stored.collect()} == {1: "", 2: "07", 3: "2024", 4: "men's/x"}
    assert [r.id for r in stored.where("category = '07'").collect()] == [2]
    assert [r.id for r in stored.where("category = ''").collect()] == [1]


def test_refine_splits_input_into_silver_and_rejects(spark, root):
    rows = [record(n) for n in range(10)] + [record(3, at=T2), record("x"), record(11, title=None)]
    write_bronze(bronze(spark, root, rows), root + "/bronze")
    done = refine(spark, root + "/bronze", root + "/silver", root + "/rejects")
    assert (done.rejected, done.rows) == (2, 10)
    reasons = {r._reject_reason for r in spark.read.parquet(root + "/rejects").collect()}
    assert reasons == {"type:id", "required:title"}
    assert read_silver(spark, root + "/silver").count() == 10


def test_refine_without_rejects_leaves_an_empty_reject_table(spark, root):
    write_bronze(bronze(spark, root, [record("x")]), root + "/bronze")
    refine(spark, root + "/bronze", root + "/silver", root + "/rejects")
    write_bronze(bronze(spark, root, [record(1)]), root + "/bronze")
    assert refine(spark, root + "/bronze", root + "/silver", root + "/rejects").rejected == 0
    assert spark.read.parquet(root + "/rejects").count() == 0


def test_silver_without_rows_can_be_read(spark, root):
    write_bronze(bronze(spark, root, [record("x")]), root + "/bronze")
    assert refine(spark, root + "/bronze", root + "/silver", root + "/rejects").rows == 0
    assert read_silver(spark, root + "/silver").count() == 0


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_results_do_not_depend_on_ansi_mode(spark, root, ansi):
    rows = [record(1, price=1e12), record(2, price="n/a"), record("x"), record(3, rating=("a", "b"))]
    raw = bronze(spark, root, rows)
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        assert set(by_key(clean(raw))) == {3}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_conform_keeps_every_accepted_row(spark, root):
    raw = bronze(spark, root, [record(1), record(1), record("x")])
    assert conform(accepted(label_rejects(raw))).count() == 2


@pytest.mark.parametrize("aqe", ["true", "false"])
def test_rejects_are_written_when_every_row_is_one(spark, root, aqe):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
        rows = [record("x"), record(None), record(3, price="n/a")]
        write_bronze(bronze(spark, root, rows).repartition(4), root + "/bronze")
        done = refine(spark, root + "/bronze", root + "/silver", root + "/rejects")
        assert (done.rejected, done.rows) == (3, 0)
        assert spark.read.parquet(root + "/rejects").count() == 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
