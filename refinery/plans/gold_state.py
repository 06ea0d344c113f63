"""Gold that follows the merges: stored sums, counts, extremes and candidates, moved by what a batch changed.

Each merge leaves its changed keys in a feed, as the rows were before and are after it. The state of
the gold tables is a numbered version, which holds the feed up to that batch. To bring it up to
date the rows before are taken off and the rows after are added. What cannot be taken off is read
again, alone: the extremes of a category that lost one, and the top list if too few of its rows are
left. A version counts once it is whole, so a run that dies in between goes on from the last one.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from refinery.functions import tier
from refinery.operators.ranking import top_n
from refinery.plans.gold import CENTS, best_first, category_kpis, listed, price_buckets, write_gold
from refinery.roles import DEFAULT_ROLES, Roles
from refinery.sources.tables import read_silver
from refinery.storage import drop_table, numbered, set_mark, table_exists

SIDE = "__side"
#: Exact for ratings of up to 20 digits before the point and 18 behind it, in any order.
EXACT = "decimal(38,18)"
#: The stored list is so many times as long as the top list, so that it outlives withdrawn rows.
RESERVE = 10
_NUMBERS = ("n", "value", "n_rated", "rates", "n_odd", "n_reviewed", "reviews")


# --- the feed ---------------------------------------------------------------------------


def _feed(state: str) -> str:
    return f"{state.rstrip('/')}/feed"


def write_feed(before: DataFrame, after: DataFrame, state: str, batch_id: int, roles: Roles = DEFAULT_ROLES) -> None:
    """Store the changed keys of one batch: rows before it with side -1, rows after it with side 1.

    A batch that is repeated after it changed the table would find its own rows, so the feed of the
    first attempt stays.
    """
    folder = f"{_feed(state)}/batch={batch_id}"
    if table_exists(before.sparkSession, f"{folder}/_SUCCESS"):
        return
    names = [roles.key, roles.title, roles.category, roles.price, "rating_rate", "rating_count", "is_valid"]
    sides = [df.select(*names, F.lit(side).alias(SIDE)) for df, side in ((before, -1), (after, 1))]
    sides[0].unionByName(sides[1]).write.mode("overwrite").parquet(folder)


def forget(spark: SparkSession, state: str) -> None:
    """Drop the state: the next :func:`refresh` builds it from all of silver."""
    drop_table(spark, state)


# --- categories -------------------------------------------------------------------------


def _category(roles: Roles) -> Column:
    return F.coalesce(F.col(roles.category), F.lit("")).alias("category")


def _numbers(roles: Roles) -> list[Column]:
    """What can be added and taken off, over rows with a side."""
    sign, rate = F.col(SIDE), F.col("rating_rate").try_cast(EXACT)
    scale = T.DataType.fromDDL(roles.price_type).scale
    counted = {"n": F.lit(True), "n_rated": rate.isNotNull(), "n_odd": F.col("rating_rate").isNotNull() & rate.isNull(),
               "n_reviewed": F.col("rating_count").isNotNull()}
    found = {name: F.sum(F.when(condition, sign).otherwise(0)).cast("bigint") for name, condition in counted.items()}
    found["value"] = F.coalesce(F.sum(F.col(roles.price) * sign), F.lit(0)).cast(f"decimal(38,{scale})")
    found["rates"] = F.coalesce(F.sum((rate * sign).cast(EXACT)), F.lit(0)).cast(EXACT)
    found["reviews"] = F.coalesce(F.sum(F.col("rating_count").cast("bigint") * sign), F.lit(0)).cast("bigint")
    return [found[name].alias(name) for name in _NUMBERS]


def _built_categories(silver: DataFrame, roles: Roles) -> DataFrame:
    price = F.col(roles.price)
    rows = silver.where("is_valid").withColumn(SIDE, F.lit(1))
    return rows.groupBy(_category(roles)).agg(*_numbers(roles), F.min(price).alias("least"), F.max(price).alias("most"))


def _moved_categories(old: DataFrame, feed: DataFrame, roles: Roles) -> DataFrame:
    """The state with one batch applied; ``open`` marks categories that lost an extreme."""
    after, before = (F.when(F.col(SIDE) == side, F.col(roles.price)) for side in (1, -1))
    delta = feed.where("is_valid").groupBy(_category(roles)).agg(
        *[number.alias(f"d_{name}") for number, name in zip(_numbers(roles), _NUMBERS)],
        F.min(after).alias("d_least"), F.max(after).alias("d_most"), F.min(before).alias("lost_least"), F.max(before).alias("lost_most"),
    )
    lost = F.coalesce((F.col("lost_least") <= F.col("least")) & ~F.coalesce(F.col("d_least") <= F.col("least"), F.lit(False)), F.lit(False))
    lost |= F.coalesce((F.col("lost_most") >= F.col("most")) & ~F.coalesce(F.col("d_most") >= F.col("most"), F.lit(False)), F.lit(False))
    kinds = {f.name: f.dataType for f in old.schema.fields}
    added = [(F.coalesce(name, F.lit(0)) + F.coalesce(f"d_{name}", F.lit(0))).cast(kinds[name]).alias(name) for name in _NUMBERS]
    moved = old.join(delta, "category", "full").select(
        "category", *added, F.least("least", "d_least").alias("least"), F.greatest("most", "d_most").alias("most"), lost.alias("open")
    )
    return moved.where("n > 0")


def _settled(spark: SparkSession, moved: DataFrame, path: str, silver: DataFrame, roles: Roles) -> None:
    """Store the categories; those that lost an extreme get theirs from their own rows of silver."""
    seen = Observation()
    moved.observe(seen, F.count_if("open").alias("open")).write.mode("overwrite").parquet(f"{path}/open")
    stored = spark.read.parquet(f"{path}/open")
    settled = stored.drop("open")
    if seen.get["open"]:
        # The category is the table's partition column: files of other categories are not read.
        lost = stored.where("open").select(F.col("category").alias(roles.category))
        again = silver.join(lost, roles.category, "left_semi").where("is_valid").groupBy(_category(roles)).agg(
            F.min(roles.price).alias("again_least"), F.max(roles.price).alias("again_most")
        )
        names = [name for name in settled.columns if name not in ("least", "most")]
        settled = stored.join(again, "category", "left").select(
            *names, *[F.when(F.col("open"), F.col(f"again_{end}")).otherwise(F.col(end)).alias(end) for end in ("least", "most")]
        )
    settled.write.mode("overwrite").parquet(f"{path}/categories")


def _kpis(state: DataFrame, silver: DataFrame, roles: Roles) -> DataFrame:
    """The category table from its state, in the types of :func:`category_kpis`."""
    expected = category_kpis(silver, roles)
    mean = _mean("value", "n", silver.schema[roles.price].dataType)
    rated = (F.col("rates") / F.col("n_rated")).cast("double")
    values = {
        "category": F.col("category"), "product_count": F.col("n"), "avg_price": F.round(mean, CENTS), "min_price": F.col("least"),
        "max_price": F.col("most"), "total_inventory_value": F.col("value"),
        "avg_rating": F.when(F.col("n_rated") > 0, F.round(rated, CENTS)), "total_reviews": F.when(F.col("n_reviewed") > 0, F.col("reviews")),
    }
    plain = state.where("n_odd = 0").select(*[values[f.name].cast(f.dataType).alias(f.name) for f in expected.schema.fields])
    # A rating that no decimal holds, such as NaN: such a category's rows are added up as they are.
    odd = state.where("n_odd > 0").select(F.col("category").alias(roles.category))
    return plain.unionByName(category_kpis(silver.join(odd, roles.category, "left_semi"), roles))


def _mean(total: str, n: str, kind: T.DecimalType) -> Column:
    """The average of decimals with the digits that Spark's own average has."""
    precision, scale = min(kind.precision + 4, 38), min(kind.scale + 4, 38)
    return (F.col(total) / F.col(n)).cast(f"decimal({precision},{scale})")


# --- tiers ------------------------------------------------------------------------------


def _tier_sums(rows: DataFrame, roles: Roles) -> DataFrame:
    price, sign = F.col(roles.price), F.col(SIDE)
    scale = T.DataType.fromDDL(roles.price_type).scale
    return rows.groupBy(tier(price, roles.tier_bounds, roles.tier_labels).alias("price_bucket")).agg(
        F.sum(sign).cast("bigint").alias("n"),
        F.sum(F.when(price.isNotNull(), sign).otherwise(0)).cast("bigint").alias("n_priced"),
        F.coalesce(F.sum(price * sign), F.lit(0)).cast(f"decimal(38,{scale})").alias("value"),
    )


def _moved_tiers(old: DataFrame, feed: DataFrame, roles: Roles) -> DataFrame:
    """At most one row per label on either side."""
    kinds = {f.name: f.dataType for f in old.schema.fields}
    both = old.unionByName(_tier_sums(feed, roles)).groupBy("price_bucket").agg(
        *[F.sum(name).cast(kinds[name]).alias(name) for name in ("n", "n_priced", "value")]
    )
    return both.where("n > 0")


def _tiers(state: DataFrame, silver: DataFrame, roles: Roles) -> DataFrame:
    kinds = {f.name: f.dataType for f in price_buckets(silver, roles).schema.fields}
    mean = F.when(F.col("n_priced") > 0, F.round(_mean("value", "n_priced", silver.schema[roles.price].dataType), CENTS))
    return state.select("price_bucket", F.col("n").alias("product_count"), mean.cast(kinds["avg_price"]).alias("avg_price"))


# --- the top list -----------------------------------------------------------------------


def _ranked(rows: DataFrame, n: int) -> DataFrame:
    return top_n(rows, best_first("id"), n, settled=("id", "rating_rate", "rating_count"))


def _store_list(spark: SparkSession, candidates: DataFrame, path: str, n: int, floor: tuple | None) -> int:
    """Store the best candidates and the floor: all rows of silver that rank from there are on the list."""
    seen = Observation()
    candidates.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{path}/candidates")
    best = _ranked(spark.read.schema(candidates.schema).parquet(f"{path}/candidates"), n)
    best.write.mode("overwrite").parquet(f"{path}/top")
    kinds = T.StructType([candidates.schema[name] for name in ("rating_rate", "rating_count", "id")])
    if seen.get["rows"] > n:
        stored = _ranked(spark.read.schema(candidates.schema).parquet(f"{path}/top"), n).tail(1)
        floor = tuple(stored[0][name] for name in kinds.names)
    spark.createDataFrame([floor] if floor else [], kinds).coalesce(1).write.mode("overwrite").parquet(f"{path}/floor")
    return seen.get["rows"]


def _build_list(spark: SparkSession, silver: DataFrame, path: str, roles: Roles) -> None:
    # One row more than the list tells whether it was cut.
    n = roles.top_n * RESERVE
    _store_list(spark, _ranked(listed(silver, roles), n + 1), path, n, None)


def _move_list(spark: SparkSession, old: str, feed: DataFrame, path: str, silver: DataFrame, roles: Roles) -> None:
    kept = spark.read.parquet(f"{old}/top")
    floors = spark.read.parquet(f"{old}/floor").collect()  # one row at most
    floor = tuple(floors[0]) if floors else None
    changed = feed.select(F.col(roles.key).alias("id")).distinct()
    added = listed(feed.where(F.col(SIDE) == 1), roles)
    if floor:
        kinds = kept.schema
        rate, count, key = (F.lit(value).cast(kinds[name].dataType) for value, name in zip(floor, ("rating_rate", "rating_count", "id")))
        here, there = F.struct("rating_rate", "rating_count"), F.struct(rate.alias("rating_rate"), count.alias("rating_count"))
        added = added.where((here > there) | (here.eqNullSafe(there) & (F.col("id") <= key)))
    candidates = kept.join(changed, "id", "left_anti").select(*kept.columns).unionByName(added)
    left = _store_list(spark, candidates, path, roles.top_n * RESERVE, floor)
    if floor and left < roles.top_n:
        _build_list(spark, silver, path, roles)


# --- versions ---------------------------------------------------------------------------


def _mark(roles: Roles) -> str:
    """The name of the empty folder that a whole version holds; other roles or thresholds give another."""
    return f"_whole-{hashlib.sha256(repr(roles).encode()).hexdigest()[:16]}"


def _versions(spark: SparkSession, state: str, roles: Roles) -> list[int]:
    root, mark = state.rstrip("/"), _mark(roles)
    return [n for n in numbered(spark, root, "v=") if table_exists(spark, f"{root}/v={n}/{mark}")]


def refresh(
    spark: SparkSession, silver_path: str, state: str, gold: str, roles: Roles = DEFAULT_ROLES, *, swap: bool = True
) -> None:
    """Bring the state up to the last batch of its feed, and write the gold tables from it.

    Without a state, or with one of other roles, it is built from all of silver. Otherwise what is read grows with the changed
    keys and with the tables of the state, not with silver, but for categories that lost an extreme.
    The average rating comes from an exact sum; one of doubles, as in a full build, can differ by
    the last bit, and so by one cent where the average lies on the edge of rounding.
    """
    silver, root = read_silver(spark, silver_path, roles=roles), state.rstrip("/")
    versions, batches = _versions(spark, state, roles), _batches(spark, state)
    if not versions:
        version = max(batches, default=0)
        path = f"{root}/v={version}"
        drop_table(spark, path)
        _built_categories(silver, roles).write.mode("overwrite").parquet(f"{path}/categories")
        _tier_sums(silver.withColumn(SIDE, F.lit(1)), roles).write.mode("overwrite").parquet(f"{path}/tiers")
        _build_list(spark, silver, path, roles)
        set_mark(spark, f"{path}/{_mark(roles)}")
    else:
        version = max(versions)
        for batch in sorted(b for b in batches if b > version):
            _apply(spark, f"{root}/v={version}", f"{root}/v={batch}", f"{_feed(state)}/batch={batch}", silver, roles)
            version = batch
    for table, build in _tables(spark, f"{root}/v={version}", silver, roles).items():
        write_gold(build, gold, table, swap=swap)
    for old in numbered(spark, root, "v="):
        if old != version:
            drop_table(spark, f"{root}/v={old}")
    for old in batches:
        # The last one may still be repeated.
        if old < version:
            drop_table(spark, f"{_feed(state)}/batch={old}")


def _batches(spark: SparkSession, state: str) -> list[int]:
    feed = _feed(state)
    return [n for n in numbered(spark, feed, "batch=") if table_exists(spark, f"{feed}/batch={n}/_SUCCESS")]


def _apply(spark: SparkSession, old: str, new: str, feed_path: str, silver: DataFrame, roles: Roles) -> None:
    feed = spark.read.parquet(feed_path)
    _settled(spark, _moved_categories(spark.read.parquet(f"{old}/categories"), feed, roles), new, silver, roles)
    _moved_tiers(spark.read.parquet(f"{old}/tiers"), feed, roles).write.mode("overwrite").parquet(f"{new}/tiers")
    _move_list(spark, old, feed, new, silver, roles)
    set_mark(spark, f"{new}/{_mark(roles)}")


def _tables(spark: SparkSession, path: str, silver: DataFrame, roles: Roles) -> dict[str, DataFrame]:
    return {
        "gold_category_kpis": _kpis(spark.read.parquet(f"{path}/categories"), silver, roles),
        "gold_price_buckets": _tiers(spark.read.parquet(f"{path}/tiers"), silver, roles),
        "gold_top_products": _ranked(spark.read.parquet(f"{path}/top"), roles.top_n),
    }
