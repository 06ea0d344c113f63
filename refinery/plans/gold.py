"""Gold: the three aggregate tables built from silver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from refinery.functions import tier
from refinery.operators.ranking import top_n
from refinery.roles import DEFAULT_ROLES, Roles
from refinery.storage import publish

LOADED_AT = "_gold_loaded_at"
CENTS = 2


def _rounded(value: Column) -> Column:
    return F.round(value, CENTS)


def category_kpis(silver: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """One row per category over the valid rows.

    ``total_reviews`` and ``avg_rating`` are NULL for a category without ratings.
    """
    price = F.col(roles.price)
    measures = {
        "product_count": F.count(F.lit(1)),
        "avg_price": _rounded(F.avg(price)),
        "min_price": F.min(price),
        "max_price": F.max(price),
        "total_inventory_value": F.sum(price),
        "avg_rating": _rounded(F.avg("rating_rate")),
        "total_reviews": F.sum("rating_count"),
    }
    valid = silver.where("is_valid")
    return valid.groupBy(F.col(roles.category).alias("category")).agg(
        *[measure.alias(name) for name, measure in measures.items()]
    )


# The order of the top list: best rating first, then most reviews; ties by the lowest key.
def best_first(key: str) -> list[Column]:
    return [F.desc("rating_rate"), F.desc("rating_count"), F.asc(key)]


def listed(silver: DataFrame, roles: Roles = DEFAULT_ROLES, *, min_reviews: int | None = None) -> DataFrame:
    """The valid rows with enough reviews for the top list."""
    floor = roles.min_reviews if min_reviews is None else min_reviews
    return silver.where("is_valid").where(F.col("rating_count") >= floor).select(
        F.col(roles.key).alias("id"),
        F.col(roles.title).alias("title"),
        F.col(roles.category).alias("category"),
        F.col(roles.price).alias("price"),
        "rating_rate",
        "rating_count",
    )


def top_products(
    silver: DataFrame,
    roles: Roles = DEFAULT_ROLES,
    *,
    min_reviews: int | None = None,
    n: int | None = None,
) -> DataFrame:
    """The ``n`` best-rated valid rows with at least ``min_reviews`` reviews."""
    return top_n(
        listed(silver, roles, min_reviews=min_reviews),
        best_first("id"),
        roles.top_n if n is None else n,
        settled=("id", "rating_rate", "rating_count"),
    )


def price_buckets(silver: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Rows and average price per price tier, over valid and invalid rows alike."""
    price = F.col(roles.price)
    label = tier(price, roles.tier_bounds, roles.tier_labels)
    return silver.groupBy(label.alias("price_bucket")).agg(
        F.count(F.lit(1)).alias("product_count"),
        _rounded(F.avg(price)).alias("avg_price"),
    )


def kpis_by_level(silver: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Valid rows by category and tier, by category, by tier, and in all, from one pass and one shuffle.

    ``level`` names the columns a row is grouped by; the others are NULL in it. The average rating is
    that of the rows, not of the groups below.
    """
    price = F.col(roles.price)
    label = tier(price, roles.tier_bounds, roles.tier_labels)
    rows = silver.where("is_valid").select(
        F.col(roles.category).alias("category"), label.alias("price_bucket"), price.alias("price"), "rating_rate"
    )
    sets = [["category", "price_bucket"], ["category"], ["price_bucket"], []]
    levels = ("category and tier", "category", "tier", "all")
    grouped = rows.groupingSets(sets, "category", "price_bucket").agg(
        F.grouping_id().alias("__level"),
        F.count(F.lit(1)).alias("product_count"),
        F.sum("price").alias("total_inventory_value"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        _rounded(F.avg("rating_rate")).alias("avg_rating"),
    )
    named = F.element_at(F.array(*map(F.lit, levels)), (F.col("__level") + 1).cast("int")).alias("level")
    return grouped.select(named, *[name for name in grouped.columns if name != "__level"])


def write_gold(
    df: DataFrame, root: str, table: str, *, fmt: str = "parquet", swap: bool = True
) -> None:
    """Replace one gold table, stamped with its load time."""
    publish(
        df.withColumn(LOADED_AT, F.current_timestamp()),
        f"{root.rstrip('/')}/{table}",
        fmt=fmt,
        swap=swap,
    )
