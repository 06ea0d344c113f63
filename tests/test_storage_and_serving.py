import json
import os
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F, types as T

import refinery.storage as storage
from refinery import Roles
from records import DAY1, DAY2, T2, record, write_array, write_lines, write_text
from refinery.contracts import CATEGORY_KPIS, RAW, SERVING, TOP_PRODUCTS, enforce_contract, widened
from refinery.plans import export_tables, reports, serve_views, write_gold
from refinery.plans.medallion import Layout, replay, run, run_new
from refinery.plans.serving import jdbc_options
from refinery.sources import read_bronze, read_gold, read_if_exists, read_raw, read_silver

CONTRACT = T.StructType(
    [T.StructField("k", T.StringType(), False), T.StructField("amount", T.DecimalType(5, 2))]
)


def test_contract_orders_types_and_marks_not_null(spark):
    df = spark.createDataFrame([(Decimal("1.005"), "a", 1)], "amount decimal(10,3), k string, extra int")
    held = enforce_contract(df, CONTRACT)
    assert held.schema == CONTRACT
    assert held.collect()[0].asDict() == {"k": "a", "amount": Decimal("1.01")}


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    "row, message", [((None, Decimal(1)), "k: NULL not allowed"), (("a", Decimal(1000)), "amount: does not fit")]
)
def test_contract_violations_fail_the_write(spark, root, ansi, row, message):
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        df = spark.createDataFrame([row], "k string, amount decimal(10,2)")
        with pytest.raises(Exception, match=message):
            enforce_contract(df, CONTRACT).write.parquet(root + "/out")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_contract_needs_every_column(spark):
    with pytest.raises(ValueError, match="amount"):
        enforce_contract(spark.createDataFrame([("a",)], "k string"), CONTRACT)


def test_widened_contract():
    wide = widened(CATEGORY_KPIS, total_inventory_value=T.DecimalType(38, 2))
    assert wide["total_inventory_value"].dataType == T.DecimalType(38, 2)
    with pytest.raises(ValueError):
        widened(CATEGORY_KPIS, nothing=T.LongType())


def test_publish_may_read_what_it_replaces(spark, root):
    path = root + "/t"
    storage.publish(spark.range(3).toDF("n"), path)
    storage.publish(spark.read.parquet(path).selectExpr("n + 10 as n"), path)
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [10, 11, 12]
    assert not storage.table_exists(spark, path + "__staged")
    assert not storage.table_exists(spark, path + "__retired")


def test_a_failed_publish_leaves_the_table(spark, root):
    path = root + "/t"
    storage.publish(spark.range(3).toDF("n"), path)
    with pytest.raises(Exception, match="boom"):
        storage.publish(spark.range(3).select(F.raise_error(F.lit("boom")).cast("int").alias("n")), path)
    assert spark.read.parquet(path).count() == 3


def test_recovery_between_the_two_renames(spark, root):
    path = root + "/t"
    storage.publish(spark.range(3).toDF("n"), path)
    storage._move(spark, path, path + "__retired")
    assert storage.recover(spark, path) is True
    assert spark.read.parquet(path).count() == 3
    assert storage.recover(spark, path) is False


def test_publish_without_swap(spark, root):
    path = root + "/t"
    storage.publish(spark.range(3).toDF("n"), path, swap=False)
    storage.publish(spark.range(5).toDF("n"), path, swap=False)
    assert spark.read.parquet(path).count() == 5


def test_shared_dir_lies_in_the_folder_the_session_names(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = (storage.shared_dir(spark, "x") for _ in range(2))
    assert first.startswith(base.rstrip("/") + "/x-") and first != second


def test_missing_gold_table_is_skipped(spark, root):
    gold = spark.createDataFrame([("a", 1, Decimal("2.00"))], "price_bucket string, product_count bigint, avg_price decimal(11,2)")
    write_gold(gold, root + "/gold", "gold_price_buckets")
    done = export_tables(spark, root + "/gold", directory=root + "/serving")
    assert done == {"gold_category_kpis": False, "gold_top_products": False, "gold_price_buckets": True}
    assert read_if_exists(spark, root + "/gold", "gold_top_products") is None


def test_export_target_is_named_once(spark, root):
    with pytest.raises(ValueError):
        export_tables(spark, root)
    with pytest.raises(ValueError):
        export_tables(spark, root, jdbc_url="jdbc:x", directory="d")


def test_jdbc_options():
    options = jdbc_options("jdbc:x", "gold_top_products", TOP_PRODUCTS, numPartitions="4")
    assert options["truncate"] == "true" and options["numPartitions"] == "4"
    assert options["createTableColumnTypes"] == "price DECIMAL(10,2), rating_rate DECIMAL(4,2)"


def test_jdbc_export_reaches_the_jdbc_writer(spark, root):
    """No database is started here, so the driver lookup is as far as it can get."""
    gold = spark.createDataFrame([("a", 1, Decimal("2.00"))], "price_bucket string, product_count bigint, avg_price decimal(11,2)")
    write_gold(gold, root + "/gold", "gold_price_buckets")
    with pytest.raises(Exception, match="No suitable driver"):
        export_tables(spark, root + "/gold", jdbc_url="jdbc:none:x")


def landed(root):
    items = [
        record(n, f" Item {n} ", price, category, (4 + n % 2 / 2, 40 + 5 * n))
        for n, (price, category) in enumerate(
            [(24.99, "A"), (25, "a "), (74.99, "B"), (75, "b"), (199.99, "c"), (200, "C"), (0, "c")]
        )
    ]
    write_array(root + "/raw", DAY1, "a.json", items)
    write_array(root + "/raw", DAY2, "b.json", [record(1, "Newer", 30, "a", (5, 90), at=T2), record("x")])


def tables(spark, place):
    found = {}
    for name in SERVING:
        rows = read_gold(spark, place.serving, name).drop("_gold_loaded_at").collect()
        found[name] = sorted(map(str, rows))
    return found


def test_whole_chain_is_idempotent_and_replayable(spark, root):
    landed(root)
    place = Layout(root)
    done = run(spark, root, layout="array")
    assert (done.bronze, done.silver.rows, done.silver.rejected) == (9, 7, 1)
    assert all(done.exported.values())
    first = tables(spark, place)

    kpis = {r.category: r for r in read_gold(spark, place.serving, "gold_category_kpis").collect()}
    assert set(kpis) == {"a", "b", "c"}
    assert (kpis["a"].product_count, kpis["a"].total_inventory_value) == (2, Decimal("54.99"))
    assert kpis["c"].product_count == 2  # the row with price 0 is not valid
    buckets = read_gold(spark, place.serving, "gold_price_buckets")
    assert {r.price_bucket: r.product_count for r in buckets.collect()} == {
        "0-25": 2, "25-75": 2, "75-200": 2, "200+": 1}
    top = read_gold(spark, place.serving, "gold_top_products")
    assert [r.id for r in reports.best_products(top).collect()] == [1, 5, 3, 4, 2]
    assert [(r.category, r.id) for r in reports.best_per_category(top).collect()] == [("a", 1), ("b", 3), ("c", 5)]

    run(spark, root, layout="array")
    assert tables(spark, place) == first
    replay(spark, root)
    export_tables(spark, place.gold, directory=place.serving)
    assert tables(spark, place) == first


def test_chain_lands_records_itself(spark, root):
    records = spark.createDataFrame([(1, "a", 5.0, "x"), (2, "b", 6.0, "y")], "id int, title string, price double, category string")
    done = run(spark, root, records=records)
    assert (done.bronze, done.silver.rows) == (2, 2)
    run(spark, root, records=records)
    assert read_silver(spark, root + "/silver").count() == 2


def test_daily_runs_equal_one_full_run(spark, root):
    landed(root + "/full")
    run(spark, root + "/full", layout="array")

    daily = Layout(root + "/daily")
    landed(root + "/history")
    for day in (DAY1, DAY2):
        [name] = os.listdir(f"{root}/history/raw/ingest_date={day}")
        with open(f"{root}/history/raw/ingest_date={day}/{name}") as source:
            write_text(daily.raw, day, name, source.read())
        assert all(run_new(spark, daily.root, layout="array").values())
    assert tables(spark, daily) == tables(spark, Layout(root + "/full"))
    again = tables(spark, daily)
    run_new(spark, daily.root, layout="array")
    assert tables(spark, daily) == again


def test_daily_run_lands_records_and_takes_a_schema(spark, root):
    schema = T.StructType(RAW.fields + [T.StructField("stock", T.StringType())])
    for stock in (5, 6):
        rows = [(1, "a", 5.0, "x", stock)]
        batch = spark.createDataFrame(rows, "id int, title string, price double, category string, stock int")
        run_new(spark, root, records=batch, schema=schema)
    [row] = read_silver(spark, root + "/silver").collect()
    assert row.stock == "6"


def test_reports_as_sql(spark, root):
    landed(root)
    run(spark, root, layout="array")
    place = Layout(root)
    assert serve_views(spark, place.serving) == list(SERVING)
    kpis = read_gold(spark, place.serving, "gold_category_kpis")
    by_value = spark.sql("SELECT category FROM gold_category_kpis ORDER BY total_inventory_value DESC")
    assert by_value.collect() == reports.inventory_by_category(kpis).select("category").collect()
    share = spark.sql(
        """SELECT price_bucket, round(product_count * 100 / whole, 2) AS pct
           FROM gold_price_buckets, (SELECT sum(product_count) AS whole FROM gold_price_buckets)"""
    )
    buckets = read_gold(spark, place.serving, "gold_price_buckets")
    expected = {r.price_bucket: r.pct_of_total for r in reports.price_distribution(buckets).collect()}
    assert {r.price_bucket: r.pct for r in share.collect()} == {k: float(v) for k, v in expected.items()}
    best = spark.sql(
        """SELECT category, max_by(id, struct(rating_rate, rating_count, -id)) AS id
           FROM gold_top_products GROUP BY category ORDER BY category"""
    )
    top = read_gold(spark, place.serving, "gold_top_products")
    assert best.collect() == reports.best_per_category(top).select("category", "id").collect()


def test_a_session_without_a_shared_folder_is_refused():
    bare = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: default),
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None),
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_dir(bare, "x")
    bare.sparkContext.getCheckpointDir = lambda: "hdfs://chosen/"
    assert storage.shared_dir(bare, "x").startswith("hdfs://chosen/x-")


def test_a_wrong_layout_does_not_empty_good_tables(spark, root):
    landed(root)
    run(spark, root, layout="array")
    place = Layout(root)
    good = tables(spark, place)
    with pytest.raises(ValueError, match="no row of bronze is usable"):
        run(spark, root)
    assert tables(spark, place) == good and read_silver(spark, place.silver).count() == 7
    assert run(spark, root, allow_empty=True).silver.rows == 0
    assert read_silver(spark, place.silver).count() == 0


def test_an_empty_silver_table_has_the_columns_of_its_roles(spark, root):
    roles = Roles(key="sku", title="name", price="cost", category="kind", key_type="bigint")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("sku", "name", "cost", "kind", "_ingested_at")])
    write_array(root + "/raw", DAY1, "a.json", [{"sku": "x", "name": "a", "cost": 1, "kind": "k"}])
    done = run(spark, root, layout="array", schema=schema, roles=roles, export=False)
    assert (done.silver.rows, done.silver.rejected) == (0, 1)
    silver = read_silver(spark, root + "/silver", roles=roles)
    assert silver.schema["sku"].dataType == T.LongType() and "kind" in silver.columns
    assert read_gold(spark, root + "/gold", "gold_category_kpis").count() == 0


def test_totals_beyond_the_old_type_are_exported(spark, root):
    kpi = spark.sql(
        """SELECT 'a' AS category, 1L AS product_count, 1.00BD AS avg_price, 1.00BD AS min_price, 1.00BD AS max_price,
                  CAST(2000000000000.5 AS decimal(20,2)) AS total_inventory_value, 4.00BD AS avg_rating, 1L AS total_reviews"""
    )
    write_gold(kpi, root + "/gold", "gold_category_kpis")
    export_tables(spark, root + "/gold", directory=root + "/serving")
    [row] = read_gold(spark, root + "/serving", "gold_category_kpis").collect()
    assert row.total_inventory_value == Decimal("2000000000000.50")
    narrow = widened(CATEGORY_KPIS, total_inventory_value=T.DecimalType(14, 2))
    with pytest.raises(Exception, match="does not fit"):
        export_tables(spark, root + "/gold", directory=root + "/narrow", contracts={"gold_category_kpis": narrow})


NARROW = {"gold_price_buckets": SERVING["gold_price_buckets"]}


@pytest.mark.parametrize("chain", [run, run_new])
def test_options_of_both_chains(spark, root, chain):
    landed(root)
    chain(spark, root, layout="array", contracts=NARROW, swap=False)
    assert os.listdir(root + "/serving") == ["gold_price_buckets"]
    with pytest.raises(Exception, match="No suitable driver"):
        chain(spark, root, layout="array", jdbc_url="jdbc:none:x")


def test_one_landing_day_through_the_chain(spark, root):
    landed(root)
    assert run(spark, root, layout="array", ingest_date=DAY2).bronze == 2
    assert [r.title for r in read_silver(spark, root + "/silver").collect()] == ["Newer"]


def test_discovery_is_a_choice(spark, root):
    write_array(root + "/raw", DAY1, "a.json", [record(1, stock=5)])
    run(spark, root, layout="array")
    assert "stock" not in read_silver(spark, root + "/silver").columns
    run(spark, root, layout="array", schema=None)
    assert [r.stock for r in read_silver(spark, root + "/silver").collect()] == ["5"]


def test_the_daily_chain_keeps_unnamed_fields(spark, root):
    batch = spark.createDataFrame([(1, "a", 5.0, "x", 7)], "id int, title string, price double, category string, stock int")
    run_new(spark, root, records=batch)
    [row] = read_silver(spark, root + "/silver").collect()
    assert row._rescued == '{"stock":"7"}'


def test_the_whole_chain_keeps_unnamed_fields(spark, root):
    more = record(2, rating=(4.0, 7))
    more["rating"]["source"] = "x"
    write_lines(root + "/raw", DAY1, "a.json", [record(1, stock=5), more, record(3, rating=(4.0, 7))])
    write_text(root + "/raw", DAY1, "b.json", '{"id": 4, "title": \n[{"id": 5, "title": "t"}, {"id": 6, "title": "t", "stock": 6}]\n')
    plain = read_raw(spark, root + "/raw", schema=RAW)
    run(spark, root, export=False)
    bronze = read_bronze(spark, root + "/bronze")
    same = [c for c in plain.columns if c != "_bronze_loaded_at"]
    key = lambda r: str(r)
    assert sorted(bronze.select(same).collect(), key=key) == sorted(plain.select(same).collect(), key=key)
    rescued = {r.id: r._rescued for r in bronze.collect()}
    assert rescued["1"] == '{"stock":"5"}' and rescued["6"] == '{"stock":"6"}' and rescued["3"] is None and rescued["5"] is None
    assert '"source' in json.loads(rescued["2"])["rating"]
    kept = {r.id: r._rescued for r in read_silver(spark, root + "/silver").collect()}
    assert kept[1] == rescued["1"]


def test_run_and_run_new_refuse_each_others_bronze(spark, root):
    landed(root + "/1")
    run(spark, root + "/1", layout="array")
    with pytest.raises(ValueError, match="write_bronze"):
        run_new(spark, root + "/1", layout="array")
    landed(root + "/2")
    run_new(spark, root + "/2", layout="array")
    with pytest.raises(ValueError, match="stream"):
        run(spark, root + "/2", layout="array")
