"""Levels of aggregation, sketches of spans, and the content check."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from refinery.plans.bronze import Content, content_of, verify_content, write_watched
from refinery.plans.gold import kpis_by_level
from refinery.plans.sketches import daily_sketches, estimates, merged_sketches

SILVER = "id int, category string, price decimal(10,2), rating_rate double, is_valid boolean"


def test_levels_in_one_shuffle(spark):
    rows = [(1, "a", 10, 4.0, True), (2, "a", 30, None, True), (3, "b", 30, 1.0, True), (4, "b", 500, 2.0, False), (5, None, 1, None, True)]
    silver = spark.createDataFrame([(i, c, None if p is None else Decimal(p), r, v) for i, c, p, r, v in rows], SILVER)
    found = kpis_by_level(silver)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Expand" in plan
    got = {(r.level, r.category, r.price_bucket): (r.product_count, float(r.total_inventory_value), r.avg_rating) for r in found.collect()}
    assert got[("all", None, None)] == (4, 71.0, 2.5)
    assert got[("category", "a", None)] == (2, 40.0, 4.0) and got[("tier", None, "25-75")] == (2, 60.0, 1.0)
    # A NULL category is a group of its own beside the total.
    assert got[("category", None, None)] == (1, 1.0, None) and got[("category and tier", None, "0-25")] == (1, 1.0, None)
    assert len(got) == 4 + 3 + 2 + 1


def test_sketches_of_any_span(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 20_000).alias("key"), (F.col("id") % 5).alias("g"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("d"),
        F.col("id").cast("double").alias("x"),
    )
    daily = daily_sketches(rows, ["g"], F.col("d"), "key", "x")
    assert daily.count() == 30  # five groups on six days each
    [whole] = estimates(merged_sketches(daily), (0.1, 0.5, 0.9)).collect()
    assert whole.n == 60_000 and abs(whole.distinct_keys - 20_000) < 1_000
    for q, x in zip((0.1, 0.5, 0.9), whole.quantiles):
        assert abs(x / 60_000 - q) < 0.02
    some = {r.g: r for r in estimates(merged_sketches(daily.where("day < '2024-01-11'"), ["g"])).collect()}
    assert len(some) == 5 and all(r.n == 4_000 for r in some.values())


def test_nulls_in_sketches(spark):
    rows = spark.createDataFrame([("a", 1, None), ("a", None, 2.0), ("b", None, None)], "g string, key int, x double")
    found = estimates(merged_sketches(daily_sketches(rows, ["g"], F.lit(1), "key", "x"), ["g"]).where("g = 'a'")).collect()
    assert (found[0].n, found[0].distinct_keys, found[0].quantiles) == (2, 1, [2.0])


ROWS = [(1, "a", None, 0.5), (2, None, "a", None), (3, "", "x", 1.5), (3, "", "x", 1.5)]


def test_content_ignores_order_but_no_cell(spark, root):
    df = spark.createDataFrame(ROWS, "id int, u string, v string, x double")
    written = write_watched(df, root + "/t", partition_by="u")
    stored = spark.read.schema(df.schema).parquet(root + "/t")
    assert written.rows == 4
    write_watched(df.repartition(3), root + "/s")
    assert verify_content(spark.read.parquet(root + "/s").select("x", "v", "u", "id"), written) == written
    changed = [
        df.withColumn("x", F.when(F.col("id") == 1, 0.25).otherwise(F.col("x"))),
        df.withColumn("v", F.coalesce("v", F.lit(""))),
        df.select("id", F.col("v").alias("u"), F.col("u").alias("v"), "x"),  # two cells exchanged
        df.dropDuplicates(), df.limit(3), df.unionAll(df.limit(1)), df.withColumnRenamed("x", "y"),
    ]
    for other in changed:
        with pytest.raises(ValueError, match="was written"):
            verify_content(other, written)
    assert content_of(df.limit(0)) == Content(0, 0, 0)
    assert stored.count() == 4
