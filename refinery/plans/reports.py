"""The reports on the gold tables. Sorting belongs here, not in the stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from refinery.functions import tier_position
from refinery.operators.ranking import top_n_per_group
from refinery.operators.shares import share_of_total
from refinery.roles import TIER_LABELS


def inventory_by_category(kpis: DataFrame) -> DataFrame:
    """Q1, and the bar chart: categories by the value they hold."""
    return kpis.select(
        "category", "product_count", "avg_price", "total_inventory_value"
    ).sort(F.desc("total_inventory_value"), "category")


def rating_by_category(kpis: DataFrame) -> DataFrame:
    """Q2: reviewed categories, best rating first."""
    reviewed = kpis.where(F.col("total_reviews") > 0)
    return reviewed.select("category", "avg_rating", "total_reviews").sort(
        F.desc("avg_rating"), "category"
    )


def best_products(top: DataFrame, n: int = 10) -> DataFrame:
    """Q3, and the table visual: the top list in order."""
    columns = ["id", "title", "category", "price", "rating_rate", "rating_count"]
    order = [F.desc("rating_rate"), F.desc("rating_count"), F.asc("id")]
    return top.select(*columns).sort(*order).limit(n)


def price_distribution(buckets: DataFrame, labels: Sequence[str] = TIER_LABELS) -> DataFrame:
    """Q4: each price tier with its percentage of all rows, cheapest tier first.

    The table has at most one row per label, which bounds the whole-set window.
    """
    share = share_of_total(buckets, "product_count", few_rows=True)
    return (
        buckets.select(
            "price_bucket", "product_count", "avg_price", F.round(share, 2).alias("pct_of_total")
        )
        .sort(tier_position(F.col("price_bucket"), labels))
    )


def rating_value_score(kpis: DataFrame) -> DataFrame:
    """Q5: average rating times inventory value, highest first."""
    score = F.round(F.col("avg_rating") * F.col("total_inventory_value"), 2)
    return kpis.select(
        "category", "avg_rating", "total_inventory_value", score.alias("rating_value_score")
    ).sort(F.desc("rating_value_score"), "category")


def best_per_category(top: DataFrame) -> DataFrame:
    """Q6: the best product of each category, among those on the top list."""
    order = [F.desc("rating_rate"), F.desc("rating_count"), F.asc("id")]
    best = top_n_per_group(
        top.select("category", "id", "title", "rating_rate", "rating_count"),
        ["category"],
        order,
        settled=("id", "rating_rate", "rating_count"),
    )
    return best.sort("category")


def totals_card(silver: DataFrame) -> DataFrame:
    """The two cards: number of valid products, and the average of their ratings.

    Taken from the items, since the rounded averages of the categories cannot be averaged again:
    a product without a rating has no weight.
    """
    return silver.where("is_valid").agg(
        F.count(F.lit(1)).alias("total_products"),
        F.round(F.avg("rating_rate"), 2).alias("avg_rating"),
    )


def category_slicer(table: DataFrame, category: str) -> DataFrame:
    """Any table with a category column, cut down to one category."""
    return table.where(F.col("category") == category)
