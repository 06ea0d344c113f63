from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from refinery import Roles
from refinery.functions import tier
from refinery.operators import share_of_total
from refinery.plans import category_kpis, price_buckets, reports, top_products

COLUMNS = (
    "id int, title string, price decimal(10,2), category string, rating_rate double, "
    "rating_count int, is_valid boolean"
)


def silver(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def item(id, price="10.00", category="tools", rate=4.0, count=100, valid=True, title="t"):
    return (id, title, Decimal(price) if price is not None else None, category, rate, count, valid)


def test_kpis(spark):
    rows = [
        item(1, "10.00", rate=3.0, count=10),
        item(2, "10.01", rate=4.0, count=None),
        item(3, "20.00", rate=None, count=5),
        item(4, "-1.00", valid=False),
        item(5, None, valid=None),
        item(6, "7.00", "unrated", None, None),
    ]
    got = {r.category: r for r in category_kpis(silver(spark, rows)).collect()}
    assert set(got) == {"tools", "unrated"}
    tools = got["tools"]
    assert (tools.product_count, tools.avg_price, tools.min_price, tools.max_price) == (
        3, Decimal("13.34"), Decimal("10.00"), Decimal("20.00"))
    assert (tools.total_inventory_value, tools.avg_rating, tools.total_reviews) == (Decimal("40.01"), 3.5, 15)
    assert (got["unrated"].avg_rating, got["unrated"].total_reviews) == (None, None)


def test_top_products_threshold_and_ties(spark):
    rows = [item(n, rate=4.5, count=60) for n in range(12, 0, -1)]
    rows += [item(20, rate=5.0, count=49), item(21, rate=5.0, count=50), item(22, rate=5.0, valid=False)]
    top = top_products(silver(spark, rows).repartition(5)).collect()
    assert [r.id for r in top] == [21, 1, 2, 3, 4, 5, 6, 7, 8, 9]
    fewer = top_products(silver(spark, rows), Roles(min_reviews=0, top_n=1)).collect()
    assert [r.id for r in fewer] == [21]
    assert [r.id for r in top_products(silver(spark, rows), min_reviews=55, n=2).collect()] == [1, 2]


def test_bucket_edges(spark):
    edges = {
        "-5.00": "0-25", "0.00": "0-25", "24.99": "0-25", "25.00": "25-75", "74.99": "25-75",
        "75.00": "75-200", "199.99": "75-200", "200.00": "200+", None: "200+",
    }
    df = silver(spark, [item(n, price) for n, price in enumerate(edges)])
    roles = Roles()
    label = tier(F.col("price"), roles.tier_bounds, roles.tier_labels).alias("label")
    assert [r.label for r in df.select("id", label).orderBy("id").collect()] == list(edges.values())


def test_buckets_count_invalid_rows_and_skip_empty_tiers(spark):
    rows = [item(1, "5.00"), item(2, "-5.00", valid=False), item(3, "300.00")]
    got = {r.price_bucket: (r.product_count, r.avg_price) for r in price_buckets(silver(spark, rows)).collect()}
    assert got == {"0-25": (2, Decimal("0.00")), "200+": (1, Decimal("300.00"))}


def test_other_tiers(spark):
    roles = Roles(tier_bounds=(100,), tier_labels=("low", "high"))
    rows = [item(1, "99.99"), item(2, "100.00")]
    assert {r.price_bucket for r in price_buckets(silver(spark, rows), roles).collect()} == {"low", "high"}
    with pytest.raises(ValueError):
        Roles(tier_bounds=(1, 2), tier_labels=("a", "b"))
    with pytest.raises(ValueError):
        Roles(tier_bounds=(2, 1, 3))


@pytest.fixture
def gold(spark):
    rows = [
        item(1, "30.00", "a", 4.0, 60), item(2, "10.00", "a", 5.0, 60), item(3, "90.00", "b", 3.0, 60),
        item(4, "250.00", "c", None, None), item(5, "50.00", "b", 3.0, 70),
    ]
    df = silver(spark, rows)
    return category_kpis(df), top_products(df), price_buckets(df)


def test_reports_are_sorted(gold):
    kpis, top, buckets = gold
    assert [r.category for r in reports.inventory_by_category(kpis).collect()] == ["c", "b", "a"]
    assert [r.category for r in reports.rating_by_category(kpis).collect()] == ["a", "b"]
    assert [r.id for r in reports.best_products(top).collect()] == [2, 1, 5, 3]
    assert [r.id for r in reports.best_products(top, 2).collect()] == [2, 1]
    assert [r.price_bucket for r in reports.price_distribution(buckets).collect()] == [
        "0-25", "25-75", "75-200", "200+"]
    scores = [(r.category, r.rating_value_score) for r in reports.rating_value_score(kpis).collect()]
    assert scores == [("b", 420.0), ("a", 180.0), ("c", None)]


def test_best_per_category_sees_only_the_top_list(spark, gold):
    _, top, _ = gold
    assert [(r.category, r.id) for r in reports.best_per_category(top).collect()] == [("a", 2), ("b", 5)]


def test_distribution_adds_up(gold):
    rows = reports.price_distribution(gold[2]).collect()
    assert [float(r.pct_of_total) for r in rows] == [20.0, 40.0, 20.0, 20.0]


def test_share_of_total_is_the_same_both_ways(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 4)], "k string, n bigint")
    shares = [
        [round(float(r.p), 6) for r in df.select("k", share_of_total(df, "n", few_rows=few).alias("p")).orderBy("k").collect()]
        for few in (True, False)
    ]
    assert shares[0] == shares[1] == [14.285714, 28.571429, 57.142857]


def test_card_weighs_every_rating_alike(spark):
    rows = [
        item(1, category="x", rate=5.0), item(2, category="x", rate=None), item(3, category="x", rate=None),
        item(4, category="y", rate=1.0), item(5, category="y", rate=4.0, valid=False),
    ]
    [card] = reports.totals_card(silver(spark, rows)).collect()
    assert (card.total_products, card.avg_rating) == (4, 3.0)


def test_slicer(gold):
    assert [r.category for r in reports.category_slicer(gold[0], "b").collect()] == ["b"]
