"""Shape of the physical plans, and behaviour with a key that holds a third of the rows."""

import contextlib
import glob
import io
import re

import pytest
from pyspark.sql import functions as F

import workload
from refinery.operators import latest_per_key, merge_unique, require_fields, share_of_total, upsert
from refinery.plans import category_kpis, clean, land_records, top_products, write_silver
from refinery.plans.reports import best_per_category
from refinery.sources import read_silver

SF = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@contextlib.contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def skewed(spark, rows=30_000):
    """A third of all rows has key 0 and category 'hot'."""
    n = F.col("n")
    hot = n % 3 == 0
    return spark.range(rows).toDF("n").select(
        F.when(hot, 0).otherwise(n).cast("int").alias("id"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("c"), n % 5)).alias("category"),
        F.concat(F.lit("t"), n).alias("title"),
        (n % 300).cast("decimal(10,2)").alias("price"),
        (n % 50 / 10).alias("rating_rate"),
        (n % 100).cast("int").alias("rating_count"),
        (n % 300 > 0).alias("is_valid"),
        n.cast("timestamp").alias("at"),
        F.sha2(n.cast("string"), 256).alias("payload"),
    )


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans")) + "/silver"
    write_silver(skewed(spark), path)
    return path


def test_dedup_limits_groups_before_the_shuffle(spark):
    text = plan(latest_per_key(skewed(spark), "id", [F.desc("at")]))
    steps = re.findall(r"WindowGroupLimit|Exchange", text.split("\n\n")[0])
    assert steps == ["WindowGroupLimit", "Exchange", "WindowGroupLimit"]


def test_a_hot_key_crosses_the_shuffle_as_one_row_per_task(spark):
    df = skewed(spark).repartition(16)
    latest = latest_per_key(df.where("id = 0"), "id", [F.desc("at")])
    assert [r.title for r in latest.collect()] == ["t29997"]
    assert latest_per_key(df, "id", [F.desc("at")]).count() == 20_001


def test_kpis_aggregate_before_the_shuffle_and_read_few_columns(spark, stored):
    text = plan(category_kpis(read_silver(spark, stored)))
    assert text.count("HashAggregate") >= 2 and "partial_sum" in text
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert "payload" not in schema and "title" not in schema
    assert "EqualTo(is_valid,true)" in re.search(r"PushedFilters: \[(.*)\]", text).group(1)


def test_slicer_prunes_partitions(spark, stored):
    silver = read_silver(spark, stored)
    text = plan(category_kpis(silver.where("category = 'hot'")))
    assert re.search(r"PartitionFilters: \[.*hot", text)


def test_top_list_is_a_top_k(spark, stored):
    text = plan(top_products(read_silver(spark, stored)))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_best_per_category_has_a_group_limit(spark, stored):
    assert "WindowGroupLimit" in plan(best_per_category(top_products(read_silver(spark, stored))))


def test_share_of_an_unbounded_table_moves_no_rows(spark):
    df = skewed(spark).select("title", "rating_count")
    text = plan(df.select("title", share_of_total(df, "rating_count").alias("p")))
    assert "Window" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_required_fields_reach_the_scan(spark):
    documents = workload.table(spark, SF, "documents")
    text = plan(require_fields(documents, ["text", "lang"]).select("doc_id"))
    assert "IsNotNull(text)" in text and "IsNotNull(lang)" in text


def unique_sides(spark, root):
    skewed(spark).dropDuplicates(["id"]).write.parquet(root + "/target")
    skewed(spark, 300).dropDuplicates(["id"]).withColumn("at", F.col("at") + F.expr("interval 1 day")).write.parquet(
        root + "/changes")
    return [spark.read.parquet(f"{root}/{side}") for side in ("target", "changes")]


def test_small_changes_leave_the_target_unshuffled(spark, root):
    target, changes = unique_sides(spark, root)
    tree = plan(merge_unique(target, changes, "id", "at")).split("\n\n")[0]
    assert "BroadcastHashJoin" in tree and "SortMergeJoin" not in tree
    assert set(re.findall(r"(\w*Exchange)", tree)) == {"BroadcastExchange"}


def test_changes_over_the_threshold_are_not_broadcast(spark, root):
    target, changes = unique_sides(spark, root)
    expected = sorted(map(str, upsert(target, changes, "id", "at").collect()))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        merged = merge_unique(target, changes, "id", "at")
        assert "BroadcastExchange" not in plan(merged)
        assert sorted(map(str, merged.collect())) == expected
    assert sorted(map(str, merge_unique(target, changes, "id", "at").collect())) == expected


def test_broadcast_on_request_whatever_the_threshold(spark, root):
    target, changes = unique_sides(spark, root)
    expected = sorted(map(str, upsert(target, changes, "id", "at").collect()))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        merged = merge_unique(target, changes, "id", "at", broadcast_changes=True)
        assert set(re.findall(r"(\w*Exchange)", plan(merged).split("\n\n")[0])) == {"BroadcastExchange"}
        assert sorted(map(str, merged.collect())) == expected


def files_of(path, category):
    return glob.glob(f"{path}/category={category}/*.parquet")


def test_one_file_per_small_category(spark, stored):
    assert all(len(files_of(stored, c)) == 1 for c in ("hot", "c0", "c1"))


def test_a_hot_category_is_split_over_tasks(spark, root):
    path = root + "/silver"
    with settings(
        spark,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="200k",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="100k",
    ):
        assert write_silver(skewed(spark).repartition(16), path) == 30_000
    assert len(files_of(path, "hot")) > 1
    stored = read_silver(spark, path)
    assert stored.where("category = 'hot'").count() == 10_000


def test_a_hot_category_is_split_without_aqe(spark, root):
    path = root + "/silver"
    with settings(spark, spark__sql__adaptive__enabled="false"):
        assert write_silver(skewed(spark).repartition(16), path) == 30_000
        assert len(files_of(path, "hot")) > 1
        assert read_silver(spark, path).count() == 30_000


def test_landing_a_hot_day(spark, root):
    stamp = F.when(F.col("id") == 0, "2026-05-08T00:00:00+00:00").otherwise("2026-05-09T00:00:00+00:00")
    rows = skewed(spark).select("id", "payload", stamp.alias("_ingested_at")).repartition(16)
    with settings(
        spark,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="200k",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="100k",
    ):
        assert land_records(rows, root, keep_stamp=True) == 30_000
    assert len(glob.glob(f"{root}/ingest_date=2026-05-08/*.json")) > 1
    assert spark.read.json(root).count() == 30_000


def test_skew_does_not_change_the_sums(spark):
    rows = [tuple(r) for r in skewed(spark).select("category", "price", "is_valid").collect()]
    expected = {}
    for category, price, valid in rows:
        if valid:
            n, total = expected.get(category, (0, 0))
            expected[category] = (n + 1, total + price)
    got = {r.category: (r.product_count, r.total_inventory_value) for r in category_kpis(skewed(spark)).collect()}
    assert got == expected


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Kolkata"])
def test_queries_do_not_depend_on_the_session_zone(spark, zone):
    from compare import connect, spark_side, sql_side
    import oracle

    con = connect(SF)
    with settings(spark, spark__sql__session__timeZone=zone):
        for name in ("landing", "late", "silver", "incremental", "upsert"):
            assert spark_side(workload.QUERIES[name](spark, SF)) == sql_side(con, oracle.SQL[name]), name


def code_sizes(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("codegen")
    return [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]


def test_generated_code_stays_compilable_for_a_wide_table(spark, root):
    """Methods over 8000 bytes are interpreted by the JVM, several times slower."""
    from refinery.contracts import BRONZE
    from refinery.operators.rejects import accepted, checked
    from refinery.plans.silver import conform
    from pyspark.sql import Observation

    wide = spark.createDataFrame([], BRONZE).withColumns({f"x{n}": F.col("title") for n in range(40)})
    wide.write.parquet(root + "/bronze")
    bronze = spark.read.parquet(root + "/bronze")
    watched = checked(bronze).observe(Observation(), F.count(F.lit(1)).alias("rows"))
    assert max(code_sizes(conform(accepted(watched)))) < 8000
    with settings(spark, spark__sql__adaptive__enabled="false"):
        assert max(code_sizes(clean(bronze))) < 8000
