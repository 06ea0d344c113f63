"""The registered queries: the library's functions over the driver's tables.

Adapters give those tables the columns of raw records or of a silver table. Queries that
exercise a source or a sink write into the session's shared folder and read back.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from refinery.contracts import CATEGORY_KPIS, RAW, bronze_schema, enforce_contract
from refinery.functions import has_rating, is_valid, normalized
from refinery.operators import (
    REASON,
    apply_rows,
    as_of_join,
    diff_keys,
    diff_rows,
    history,
    label_rejects,
    late_arrivals,
    latest_per_key,
    merge_unique,
    range_join,
    rejected,
    require_fields,
    share_of_total,
    upsert,
)
from refinery.plans import (
    category_kpis,
    land_records,
    price_buckets,
    refine,
    serve_views,
    top_products,
    verify_bronze,
    write_bronze,
    write_gold,
)
from refinery.plans import reports
from refinery.plans.bronze import content_of, verify_content, write_watched
from refinery.plans.compaction import compact_bronze, vacuum_bronze
from refinery.plans.gold import kpis_by_level
from refinery.plans.gold_state import refresh
from refinery.plans.medallion import Layout, load_bronze, replay as replay_chain, run
from refinery.plans.silver import flatten_rating
from refinery.plans.sketches import daily_sketches, estimates, merged_sketches
from refinery.sources import discover_schema, read_bronze, read_gold, read_raw, read_silver
from refinery.storage import name_scratch_locally, shared_dir
from refinery.streaming import (
    admit_new_rows,
    ingest_new_files,
    merge_new_rows,
    read_accepted,
    read_aside,
    read_repeats,
)

Query = Callable[[SparkSession, str], DataFrame]

MONEY = "decimal(10,2)"
# Reviews per catalog item are 14 to 49, so the library's default of 50 would keep none.
MIN_REVIEWS = 30
RAW_EVENTS = T.StructType(RAW.fields + [T.StructField("event_id", T.StringType())])
HALF = "2024-01-16"
UNRATED = "small"
MOMENT = datetime(2024, 2, 1, 12, 30, tzinfo=timezone.utc)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in names})


# --- adapters ---------------------------------------------------------------------------


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw rows: the user is the key, so keys repeat."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("user_id").alias("id"),
        F.concat(F.lit("  "), "event_type", F.lit(" ")).alias("title"),
        F.col("value").cast(MONEY).alias("price"),
        F.concat(F.lit(" "), F.upper("event_type")).alias("category"),
        F.col("ts").alias("ingested_at"),
        "event_id",
    )


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw records with a rating struct, an ISO stamp and a field silver does not know."""
    k = F.from_json("props", "k INT")["k"]
    stamp = F.concat(F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")), F.lit("+00:00"))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"),
        F.concat(F.lit("  "), "event_type", F.lit(" ")).alias("title"),
        F.col("value").cast(MONEY).alias("price"),
        F.concat(F.lit(" "), F.upper("event_type")).alias("category"),
        F.struct((k / 16).alias("rate"), k.alias("count")).alias("rating"),
        stamp.alias("_ingested_at"),
        "event_id",
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as silver rows; rating and review count come from their order lines.

    One category and every seventh part have no rating, and some parts are not valid: a price of
    zero, an unknown price, or a blank title.
    """
    every = lambda n: F.col("p_partkey") % n == 0
    unrated = every(7) | (F.lower(F.trim("p_type")) == UNRATED)
    lines = table(spark, sf_dir, "lineitem")
    reviews = lines.groupBy("l_partkey").agg(
        F.sum(F.col("l_quantity").cast("int")).alias("quantity"),
        F.count(F.lit(1)).alias("n"),
    )
    parts = table(spark, sf_dir, "part")
    items = parts.join(reviews, parts.p_partkey == reviews.l_partkey).select(
        F.col("p_partkey").alias("id"),
        normalized(F.when(every(13), F.lit("  ")).otherwise(F.col("p_name"))).alias("title"),
        normalized(F.col("p_type"), fold_case=True).alias("category"),
        F.when(every(11), F.lit(0)).when(~every(17), F.col("p_retailprice")).cast(MONEY).alias("price"),
        F.when(~unrated, F.expr("quantity * 10 div n").cast(MONEY) / 100).cast(MONEY).alias("rating_rate"),
        F.when(~unrated, F.col("n")).cast("int").alias("rating_count"),
    )
    return items.withColumns(
        {
            "has_rating": has_rating(F.col("rating_rate")),
            "is_valid": is_valid(F.col("price"), F.col("title")),
        }
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality label that some documents have: the source of real NULLs."""
    return table(spark, sf_dir, "labels").select("doc_id", "quality")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw text records, many of them faulty: prices outside the decimal's range,
    keys that are no number, missing categories."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    urgent = F.col("o_orderpriority").startswith("1")
    return orders.select(
        F.when(urgent, F.concat(F.lit("x"), key)).otherwise(key).alias("id"),
        F.col("o_orderpriority").alias("title"),
        (F.col("o_totalprice") * 1000).cast("string").alias("price"),
        F.nullif("o_orderstatus", F.lit("P")).alias("category"),
    )


# --- gold and reports -------------------------------------------------------------------

KPI_MONEY = ("avg_price", "min_price", "max_price", "total_inventory_value", "avg_rating")


def _kpis(spark, sf_dir):
    return category_kpis(catalog(spark, sf_dir))


def _top(spark, sf_dir):
    return top_products(catalog(spark, sf_dir), min_reviews=MIN_REVIEWS)


def _buckets(spark, sf_dir):
    return price_buckets(feed(spark, sf_dir))


def kpis(spark, sf_dir):
    return doubles(_kpis(spark, sf_dir), *KPI_MONEY)


def top(spark, sf_dir):
    return doubles(_top(spark, sf_dir), "price", "rating_rate")


def buckets(spark, sf_dir):
    return doubles(_buckets(spark, sf_dir), "avg_price")


def q1(spark, sf_dir):
    report = reports.inventory_by_category(_kpis(spark, sf_dir))
    return doubles(report, "avg_price", "total_inventory_value")


def q2(spark, sf_dir):
    return doubles(reports.rating_by_category(_kpis(spark, sf_dir)), "avg_rating")


def q3(spark, sf_dir):
    return doubles(reports.best_products(_top(spark, sf_dir)), "price", "rating_rate")


def q4(spark, sf_dir):
    return doubles(reports.price_distribution(_buckets(spark, sf_dir)), "avg_price", "pct_of_total")


def q5(spark, sf_dir):
    report = reports.rating_value_score(_kpis(spark, sf_dir))
    return doubles(report, "avg_rating", "total_inventory_value", "rating_value_score")


def q6(spark, sf_dir):
    return doubles(reports.best_per_category(_top(spark, sf_dir)), "rating_rate")


def card(spark, sf_dir):
    return doubles(reports.totals_card(catalog(spark, sf_dir)), "avg_rating")


def value_share(spark, sf_dir):
    """Each part's percentage of all reviews: as many rows as the catalog, so no whole-set window."""
    items = catalog(spark, sf_dir).where("rating_count IS NOT NULL")
    share = share_of_total(items, "rating_count")
    return items.select("id", F.round(share.cast("double"), 6).alias("pct_of_total"))


def slicer(spark, sf_dir):
    chosen = reports.category_slicer(_kpis(spark, sf_dir), "promo")
    return doubles(chosen.select("category", "total_inventory_value"), "total_inventory_value")


# --- silver steps -----------------------------------------------------------------------


def dedup(spark, sf_dir):
    newest = [F.desc("ingested_at"), F.desc("event_id")]
    latest = latest_per_key(feed(spark, sf_dir), "id", newest, settled=("ingested_at", "event_id"))
    return latest.select(
        "id",
        normalized(F.col("category"), fold_case=True).alias("category"),
        normalized(F.col("title")).alias("title"),
        F.col("price").cast("double").alias("price"),
        "event_id",
    )


def required(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    labelled = documents.join(labels(spark, sf_dir), "doc_id", "left")
    return require_fields(labelled, ["quality", "text"]).select("doc_id", "lang", "quality")


def flags(spark, sf_dir):
    # The texts are trimmed before the join, so that it moves a flag and not the texts.
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", is_valid(F.col("n_chars"), normalized(F.col("text"))).alias("is_valid")
    )
    flagged = documents.join(labels(spark, sf_dir), "doc_id", "left").withColumn(
        "has_rating", has_rating(F.col("quality"))
    )
    return flagged.groupBy("has_rating", "is_valid").agg(F.count(F.lit(1)).alias("n"))


def flatten(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    rated = events.select("event_id", F.from_json("props", "rate DOUBLE, k INT").alias("parsed"))
    rated = rated.select(
        "event_id",
        F.struct(F.col("parsed.rate").alias("rate"), F.col("parsed.k").alias("count")).alias("rating"),
    )
    return flatten_rating(rated).select("event_id", "rating_count")


def rejects(spark, sf_dir):
    bad = rejected(label_rejects(raw_orders(spark, sf_dir)))
    return bad.select("id", F.col(REASON).alias("reason"))


# --- merging ----------------------------------------------------------------------------


def _split_events(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")
    return events.where(early), events.where(~early)


def upsert_union(spark, sf_dir):
    target, changes = _split_events(spark, sf_dir)
    merged = upsert(target, changes, "user_id", "ts")
    return merged.select("user_id", "event_id", "event_type", "value")


def upsert_join(spark, sf_dir):
    """The same upsert on stored tables with one row per user."""
    place = Layout(shared_dir(spark, "upsert_join"))
    sides = []
    for name, rows in zip(("target", "changes"), _split_events(spark, sf_dir)):
        latest_per_key(rows, "user_id", [F.desc("ts")]).write.parquet(place.at(name))
        sides.append(spark.read.parquet(place.at(name)))
    merged = merge_unique(*sides, "user_id", "ts")
    return merged.select("user_id", "event_id", "event_type", "value")


# --- time, ranges and versions ----------------------------------------------------------


def _micros(name: str) -> Column:
    return F.unix_micros(F.col(name).cast("timestamp")).alias(name)


def key_history(spark, sf_dir):
    """What each user did last, and from when until when."""
    states = history(table(spark, sf_dir, "events"), "user_id", "ts", ["event_type"])
    return states.select("user_id", "event_type", _micros("valid_from"), _micros("valid_to"))


def as_of(spark, sf_dir):
    """Each error with the last view of its user before it."""
    events = table(spark, sf_dir, "events")
    errors = events.where("event_type = 'error'").select("event_id", "user_id", "ts")
    views = events.where("event_type = 'view'").withColumnRenamed("ts", "seen")
    found = as_of_join(errors, views, "user_id", left_at="ts", right_at="seen", values=["value"])
    return found.select("event_id", "user_id", _micros("as_of"), "value")


def category_tiers(spark, sf_dir):
    """Parts by tiers whose bounds differ by category: thirds of its range of prices."""
    items = catalog(spark, sf_dir).select("id", "category", "price")
    low, high = F.min("price").cast("double"), F.max("price").cast("double")
    cut = items.groupBy("category").agg(*[F.floor(low + (high - low) * k / 3).alias(f"cut{k}") for k in (1, 2)])
    bounds = [(F.lit(None).cast("bigint"), "cut1", "low"), ("cut1", "cut2", "middle"), ("cut2", F.lit(None).cast("bigint"), "high")]
    tiers = cut.select(
        "category",
        F.inline(F.array(*[
            F.struct((F.col(a) if isinstance(a, str) else a).alias("lower"), (F.col(b) if isinstance(b, str) else b).alias("upper"), F.lit(label).alias("label"))
            for a, b, label in bounds
        ])),
    )
    found = range_join(items, tiers, "price", by=["category"])
    return doubles(found.groupBy("category", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("total")), "total")


def _two_catalogs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The catalog, and a later one: parts gone, dearer and new."""
    old = catalog(spark, sf_dir).select("id", "category", "price")
    dearer = F.when(F.col("id") % 5 == 0, (F.col("price") + 1).cast(MONEY)).otherwise(F.col("price"))
    added = old.where("id % 9 = 0").withColumn("id", F.col("id") + 10_000_000)
    return old, old.where("id % 8 <> 0").withColumn("price", dearer).unionByName(added)


def catalog_changes(spark, sf_dir):
    changes = diff_keys(*_two_catalogs(spark, sf_dir), "id")
    prices = [F.col(f"{side}.price").cast("double").alias(side) for side in ("before", "after")]
    return changes.select("id", "change", *prices)


def catalog_applied(spark, sf_dir):
    """The later catalog again, from the earlier one and the rows that differ."""
    old, new = _two_catalogs(spark, sf_dir)
    return doubles(apply_rows(old, diff_rows(old, new)), "price")


def kpi_levels(spark, sf_dir):
    return doubles(kpis_by_level(catalog(spark, sf_dir)), "total_inventory_value", "min_price", "max_price", "avg_rating")


def sketch_spans(spark, sf_dir):
    """Users and median value of the first weeks, from sketches by day, beside the exact ones.

    The estimates may be off by 5 percent of the users and 2 percent of the ranks.
    """
    place = Layout(shared_dir(spark, "sketch_spans"))
    events = table(spark, sf_dir, "events")
    daily_sketches(events, ["event_type"], F.to_date("ts"), "user_id", "value").write.parquet(place.at("sketches"))
    days = F.col("day") < F.lit(HALF).cast("date")
    found = estimates(merged_sketches(spark.read.parquet(place.at("sketches")).where(days), ["event_type"]))
    span = events.where(F.to_date("ts") < F.lit(HALF).cast("date"))
    compared = span.join(found.select("event_type", "distinct_keys", F.col("quantiles")[0].alias("median")), "event_type")
    exact = compared.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"), F.any_value("distinct_keys").alias("estimate"),
        F.avg((F.col("value") < F.col("median")).cast("int")).alias("below"), F.avg((F.col("value") <= F.col("median")).cast("int")).alias("up_to"),
    )
    users_close = F.abs(F.col("estimate") - F.col("users")) <= F.greatest(0.05 * F.col("users"), F.lit(1))
    return exact.select(
        "event_type", "n", "users", users_close.alias("users_close"), ((F.col("below") <= 0.52) & (F.col("up_to") >= 0.48)).alias("median_close")
    )


# --- sources and sinks ------------------------------------------------------------------


def _landed_on() -> Column:
    return F.regexp_extract("_source_file", r"ingest_date=(\d{4}-\d{2}-\d{2})", 1).cast("date")


def _land(spark, sf_dir, root: str) -> Layout:
    place = Layout(root)
    land_records(raw_feed(spark, sf_dir), place.raw, keep_stamp=True)
    return place


def _raw_rows(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("id").cast("bigint").alias("id"),
        "category",
        F.col("price").cast("double").alias("price"),
        F.col("rating.count").cast("int").alias("rating_count"),
        _landed_on().alias("ingest_date"),
    )


def raw_nested(spark, sf_dir):
    """A member of the rating that no schema names."""
    place = Layout(shared_dir(spark, "raw_nested"))
    source = F.col("rating").withField("source", F.col("event_id") % 3)
    land_records(raw_feed(spark, sf_dir).withColumn("rating", source), place.raw, keep_stamp=True)
    raw = read_raw(spark, place.raw, schema=discover_schema(spark, place.raw))
    return raw.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("rating.source").cast("bigint").alias("source"),
        F.col("rating.count").cast("int").alias("rating_count"),
    )


def raw_mistyped(spark, sf_dir):
    """Every tenth record has a plain number for its rating: its text has to stay."""
    place = Layout(shared_dir(spark, "raw_mistyped"))
    records, plain = raw_feed(spark, sf_dir), F.col("event_id") % 10 == 0
    land_records(records.where(~plain), place.raw, keep_stamp=True)
    land_records(records.where(plain).withColumn("rating", F.lit(4.5)), place.raw, keep_stamp=True)
    raw = read_raw(spark, place.raw, schema=RAW_EVENTS)
    return raw.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("rating.count").cast("int").alias("rating_count"),
        F.get_json_object("_corrupt_record", "$.rating").cast("double").alias("rating_text"),
    )


def raw_array(spark, sf_dir):
    """Files that hold one JSON array of at most 500 records each."""
    place = Layout(shared_dir(spark, "raw_array"))
    records = raw_feed(spark, sf_dir)
    one = F.to_json(F.collect_list(F.struct(*records.columns))).alias("value")
    # 500 event numbers fall into one file, whatever the table's size.
    day, file = F.substring("_ingested_at", 1, 10).alias("ingest_date"), F.expr("event_id div 500").alias("file")
    arrays = records.groupBy(day, file).agg(one)
    arrays.repartition("ingest_date", "file").write.partitionBy("ingest_date", "file").option("maxRecordsPerFile", 1).text(place.raw)
    return _raw_rows(read_raw(spark, place.raw, schema=RAW_EVENTS, layout="array"))


def array_fields(spark, sf_dir):
    """Indented arrays through the chain: a field and a member that no schema names, and every tenth
    record with a plain number for its rating. Numbers keep the digits they are written with."""
    place = Layout(shared_dir(spark, "array_fields"))
    records, pretty = raw_feed(spark, sf_dir), {"pretty": "true"}
    rest = [name for name in records.columns if name != "rating"]
    source = F.col("rating").withField("source", F.col("event_id") % 3)
    plain = F.to_json(F.struct(*rest, F.lit(4.5).cast("decimal(3,2)").alias("rating")), pretty)
    nested = F.to_json(F.struct(*rest, source.alias("rating")), pretty)
    text = F.when(F.col("event_id") % 10 == 0, plain).otherwise(nested)
    day, file = F.substring("_ingested_at", 1, 10).alias("ingest_date"), F.expr("event_id div 500").alias("file")
    joined = F.concat(F.lit("[\n"), F.array_join(F.collect_list(text), ",\n"), F.lit("\n]")).alias("value")
    arrays = records.groupBy(day, file).agg(joined)
    arrays.repartition("ingest_date", "file").write.partitionBy("ingest_date", "file").option("maxRecordsPerFile", 1).text(place.raw)
    run(spark, place.root, layout="array", export=False)
    return read_bronze(spark, place.bronze).select(
        F.get_json_object("_rescued", "$.event_id").cast("bigint").alias("event_id"),
        "price",
        F.get_json_object(F.get_json_object("_rescued", "$.rating"), "$.source").cast("bigint").alias("source"),
        F.col("rating.count").cast("int").alias("rating_count"),
        F.nullif(F.regexp_extract("_corrupt_record", '"rating":([0-9.]+)', 1), F.lit("")).alias("rating_text"),
    )


def landing_stamped(spark, sf_dir):
    """Records without a stamp, landed at one moment."""
    place = Layout(shared_dir(spark, "landing_stamped"))
    land_records(raw_feed(spark, sf_dir).drop("_ingested_at"), place.raw, moment=MOMENT)
    raw = read_raw(spark, place.raw, schema=RAW_EVENTS)
    return raw.groupBy("_ingested_at", _landed_on().alias("ingest_date")).agg(F.count(F.lit(1)).alias("n"))


def landing(spark, sf_dir):
    place = _land(spark, sf_dir, shared_dir(spark, "landing"))
    raw = read_raw(spark, place.raw, schema=RAW_EVENTS)
    return raw.groupBy(_landed_on().alias("ingest_date")).agg(F.count(F.lit(1)).alias("n"))


def raw_scan(spark, sf_dir):
    place = _land(spark, sf_dir, shared_dir(spark, "raw_scan"))
    return _raw_rows(read_raw(spark, place.raw, schema=RAW_EVENTS))


def raw_discovered(spark, sf_dir):
    place = _land(spark, sf_dir, shared_dir(spark, "raw_discovered"))
    return _raw_rows(read_raw(spark, place.raw))


def raw_day(spark, sf_dir):
    place = _land(spark, sf_dir, shared_dir(spark, "raw_day"))
    return _raw_rows(read_raw(spark, place.raw, schema=RAW_EVENTS, ingest_date=HALF))


def bronze_append(spark, sf_dir):
    """A bronze table that gained a column between two appends."""
    place = _land(spark, sf_dir, shared_dir(spark, "bronze_append"))
    before = F.col("_ingested_at") < HALF
    old = read_raw(spark, place.raw, schema=RAW).where(before)
    new = read_raw(spark, place.raw, schema=RAW_EVENTS).where(~before)
    write_bronze(old, place.bronze, mode="append")
    write_bronze(new, place.bronze, mode="append")
    bronze = read_bronze(spark, place.bronze, merge_schema=True)
    return bronze.select(
        F.col("id").cast("bigint").alias("id"),
        F.col("price").cast("double").alias("price"),
        F.col("event_id").cast("bigint").alias("event_id"),
    )


def bronze_overwrite(spark, sf_dir):
    """A second overwrite with other columns keeps those of the table it replaces."""
    place = _land(spark, sf_dir, shared_dir(spark, "bronze_overwrite"))
    raw = read_raw(spark, place.raw, schema=RAW_EVENTS)
    write_bronze(raw.drop("event_id").withColumn("first_only", F.lit("old")), place.bronze)
    write_bronze(raw.where(F.col("_ingested_at") >= HALF), place.bronze)
    return read_bronze(spark, place.bronze).select(
        F.col("event_id").cast("bigint").alias("event_id"), F.col("id").cast("bigint").alias("id"), "first_only"
    )


def bronze_count(spark, sf_dir):
    place = _land(spark, sf_dir, shared_dir(spark, "bronze_count"))
    written = write_bronze(read_raw(spark, place.raw, schema=RAW_EVENTS), place.bronze)
    verify_bronze(spark, place.bronze, written)
    return read_bronze(spark, place.bronze).agg(F.count(F.lit(1)).alias("n"))


def bronze_content(spark, sf_dir):
    """Rows written, whether they are read back as they were, and whether one altered cell is found."""
    place = _land(spark, sf_dir, shared_dir(spark, "bronze_content"))
    written = write_watched(read_raw(spark, place.raw, schema=RAW_EVENTS), place.bronze)
    stored = read_bronze(spark, place.bronze)
    verify_content(stored, written)
    altered = stored.withColumn("price", F.when(F.col("event_id") == "7", F.concat("price", F.lit("0"))).otherwise(F.col("price")))
    found = content_of(altered) != written
    return stored.agg(F.count(F.lit(1)).alias("n"), F.lit(written.rows).cast("bigint").alias("written"), F.lit(found).alias("found"))


def _silver_rows(silver: DataFrame) -> DataFrame:
    return silver.select(
        "id",
        "title",
        F.col("price").cast("double").alias("price"),
        "category",
        "rating_rate",
        "rating_count",
        "has_rating",
        "is_valid",
        F.col("event_id").cast("bigint").alias("event_id"),
    )


def _refined(spark, sf_dir, name: str) -> Layout:
    place = _land(spark, sf_dir, shared_dir(spark, name))
    load_bronze(spark, place, schema=RAW_EVENTS)
    refine(spark, place.bronze, place.silver, place.rejects)
    return place


def silver(spark, sf_dir):
    place = _refined(spark, sf_dir, "silver")
    return _silver_rows(read_silver(spark, place.silver))


def silver_flags(spark, sf_dir):
    """Events of which some have no value and some a blank title."""
    place = Layout(shared_dir(spark, "silver_flags"))
    free, blank = F.col("event_id") % 5 == 0, F.col("event_id") % 3 == 0
    records = raw_feed(spark, sf_dir).withColumns(
        {
            "price": F.when(free, F.lit(0)).otherwise(F.col("price")).cast(MONEY),
            "title": F.when(blank, F.lit("   ")).otherwise(F.col("title")),
        }
    )
    land_records(records, place.raw, keep_stamp=True)
    load_bronze(spark, place, schema=RAW_EVENTS)
    refine(spark, place.bronze, place.silver, place.rejects)
    return read_silver(spark, place.silver).select("id", "title", "has_rating", "is_valid")


def rejects_stored(spark, sf_dir):
    """The table of rejects that the chain writes."""
    place = Layout(shared_dir(spark, "rejects_stored"))
    land_records(raw_orders(spark, sf_dir), place.raw, moment=MOMENT)
    load_bronze(spark, place)
    refine(spark, place.bronze, place.silver, place.rejects)
    return spark.read.parquet(place.rejects).select("id", F.col(REASON).alias("reason"))


def load_times(spark, sf_dir):
    """Per layer: rows, rows without a load time, and distinct load times."""
    place = _refined(spark, sf_dir, "load_times")
    layers = {
        "bronze": (read_bronze(spark, place.bronze), "_bronze_loaded_at"),
        "silver": (read_silver(spark, place.silver), "_silver_loaded_at"),
    }
    write_gold(price_buckets(layers["silver"][0]), place.gold, "gold_price_buckets")
    layers["gold"] = (read_gold(spark, place.gold, "gold_price_buckets"), "_gold_loaded_at")
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col(at).isNull()).alias("missing"),
            F.count_distinct(at).alias("moments"),
        ).withColumn("layer", F.lit(layer))
        for layer, (df, at) in layers.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def replay(spark, sf_dir):
    """Silver and gold built again from the stored bronze table."""
    place = _refined(spark, sf_dir, "replay")
    replay_chain(spark, place.root)
    stored = read_gold(spark, place.gold, "gold_category_kpis").drop("_gold_loaded_at")
    return doubles(stored, *KPI_MONEY)


def gold_kpis(spark, sf_dir):
    place = _refined(spark, sf_dir, "gold_kpis")
    write_gold(category_kpis(read_silver(spark, place.silver)), place.gold, "gold_category_kpis")
    stored = read_gold(spark, place.gold, "gold_category_kpis").drop("_gold_loaded_at")
    return doubles(stored, *KPI_MONEY)


def serving_buckets(spark, sf_dir):
    """The whole chain up to the serving tables."""
    place = _land(spark, sf_dir, shared_dir(spark, "serving_buckets"))
    run(spark, place.root, schema=RAW_EVENTS)
    served = read_gold(spark, place.serving, "gold_price_buckets").drop("_gold_loaded_at")
    return doubles(served, "avg_price")


def report_sql(spark, sf_dir):
    """A report as SQL text over the stored gold tables: the reviewed categories' share of value."""
    place = Layout(shared_dir(spark, "report_sql"))
    write_gold(_kpis(spark, sf_dir), place.gold, "gold_category_kpis")
    serve_views(spark, place.gold)
    report = spark.sql(
        """SELECT sum(product_count) AS total_products,
                  count_if(total_reviews > 0) AS reviewed_categories,
                  sum(total_reviews) AS total_reviews,
                  sum(total_inventory_value) AS total_value
           FROM gold_category_kpis"""
    )
    return doubles(report, "total_value")


def contract(spark, sf_dir):
    stamped = _kpis(spark, sf_dir).withColumn("_gold_loaded_at", F.current_timestamp())
    held = enforce_contract(stamped, CATEGORY_KPIS).drop("_gold_loaded_at")
    return doubles(held, *KPI_MONEY)


def late(spark, sf_dir):
    """Events landed at the Monday after they happened; those more than three days late."""
    place = Layout(shared_dir(spark, "late"))
    monday = F.date_add(F.to_date(F.date_trunc("week", F.substring("_ingested_at", 1, 10))), 7)
    weekly = raw_feed(spark, sf_dir).withColumn("ingest_date", monday)
    land_records(weekly, place.raw, keep_stamp=True)
    tardy = late_arrivals(read_raw(spark, place.raw, schema=RAW_EVENTS), allowed_days=3)
    return tardy.select(
        F.col("event_id").cast("bigint").alias("event_id"), "ingested_on", "ingest_date", "days_late"
    )


def _two_loads(
    spark, sf_dir, name: str, after_load=lambda place: None, schema=RAW_EVENTS, aged=None, **options
) -> Layout:
    place = Layout(shared_dir(spark, name))
    records = raw_feed(spark, sf_dir)
    before = F.col("_ingested_at") < HALF
    for number, part in enumerate((records.where(before), records.where(~before))):
        land_records(part, place.raw, keep_stamp=True)
        if number and aged:
            aged(place)
        ingest_new_files(
            spark, place.raw, place.bronze, place.at("ingest_state"), schema=schema, **options
        ).awaitTermination()
        after_load(place)
    return place


def _aged(spark, days: int):
    """Make the files of the second half look ``days`` older than they are."""

    def age(place: Layout) -> None:
        path = spark._jvm.org.apache.hadoop.fs.Path
        store = path(place.raw).getFileSystem(spark._jsc.hadoopConfiguration())
        for folder in store.listStatus(path(place.raw)):
            if folder.isDirectory() and folder.getPath().getName().partition("=")[2] >= HALF:
                for file in store.listStatus(folder.getPath()):
                    moment = file.getModificationTime() - days * 86_400_000
                    store.setTimes(file.getPath(), moment, -1)

    return age


def incremental(spark, sf_dir):
    place = _two_loads(spark, sf_dir, "incremental")
    bronze = read_bronze(spark, place.bronze)
    return bronze.groupBy(_landed_on().alias("ingest_date")).agg(F.count(F.lit(1)).alias("n"))


def incremental_late(spark, sf_dir):
    """The second load's files are forty days older than the first's; none may be left out."""
    place = _two_loads(spark, sf_dir, "incremental_late", aged=_aged(spark, 40))
    bronze = read_bronze(spark, place.bronze)
    return bronze.select(F.col("event_id").cast("bigint").alias("event_id"), _landed_on().alias("ingest_date"))


def incremental_fields(spark, sf_dir):
    """A field that the stream's schema does not name."""
    place = _two_loads(spark, sf_dir, "incremental_fields", schema=RAW, rescue=True)
    event = F.get_json_object("_rescued", "$.event_id").cast("bigint")
    return read_bronze(spark, place.bronze).select(
        event.alias("event_id"), F.col("id").cast("bigint").alias("id"), F.col("rating.count").cast("int").alias("rating_count")
    )


def batch_fields(spark, sf_dir):
    """A field that the schema of the whole chain's default does not name."""
    place = _land(spark, sf_dir, shared_dir(spark, "batch_fields"))
    run(spark, place.root, export=False)
    event = F.get_json_object("_rescued", "$.event_id").cast("bigint")
    return read_bronze(spark, place.bronze).select(
        event.alias("event_id"), F.col("id").cast("bigint").alias("id"), F.col("rating.count").cast("int").alias("rating_count")
    )


def admitted(spark, sf_dir):
    """Two loads: the second brings records held back from the first, and copies of others."""
    place, schema = Layout(shared_dir(spark, "admitted")), bronze_schema(RAW_EVENTS)
    records, lot = raw_feed(spark, sf_dir), F.col("event_id") % 10
    before = F.col("_ingested_at") < HALF
    again = records.where(~before & (lot == 2))
    for part in (records.where(before & (lot != 0)), records.where(~before | lot.isin(0, 1)).unionByName(again)):
        land_records(part, place.raw, keep_stamp=True)
        ingest_new_files(spark, place.raw, place.bronze, place.at("ingest_state"), schema=RAW_EVENTS).awaitTermination()
        admit_new_rows(
            spark, place.bronze, place.at("admitted"), place.at("admit_state"), key=["event_id"], schema=schema
        ).awaitTermination()
    root, event = place.at("admitted"), F.col("event_id").cast("bigint").alias("event_id")
    once = F.lit(1).cast("bigint").alias("n")
    accepted = read_accepted(spark, root, schema).select(event, F.lit("accepted").alias("outcome"), once)
    aside = read_aside(spark, root, schema).select(event, F.col("_admission").alias("outcome"), once)
    repeats = read_repeats(spark, root, schema, ["event_id"])
    return accepted.union(aside).union(repeats.select(event, F.lit("repeated"), "copies"))


def incremental_silver(spark, sf_dir):
    def merge(place: Layout) -> None:
        merge_new_rows(
            spark,
            place.bronze,
            place.silver,
            place.rejects,
            place.at("merge_state"),
            schema=bronze_schema(RAW_EVENTS),
        ).awaitTermination()

    place = _two_loads(spark, sf_dir, "incremental_silver", merge)
    return _silver_rows(read_silver(spark, place.silver))


def bronze_compacted(spark, sf_dir):
    """Two loads, packed after each; the files of the first are removed before the second."""

    def pack(place: Layout) -> None:
        compact_bronze(spark, place.bronze)
        vacuum_bronze(spark, place.bronze, keep=1, drop_covered=True)

    place = _two_loads(spark, sf_dir, "bronze_compacted", pack)
    return _raw_rows(read_bronze(spark, place.bronze))


def _followed(spark, sf_dir, name: str) -> Layout:
    """Two loads; after each, gold follows what the merge changed."""

    def merge(place: Layout) -> None:
        merge_new_rows(
            spark, place.bronze, place.silver, place.rejects, place.at("merge_state"),
            schema=bronze_schema(RAW_EVENTS), gold_state=place.at("gold_state"),
        ).awaitTermination()
        refresh(spark, place.silver, place.at("gold_state"), place.gold)

    return _two_loads(spark, sf_dir, name, merge)


def incremental_gold(spark, sf_dir):
    place = _followed(spark, sf_dir, "incremental_gold")
    return doubles(read_gold(spark, place.gold, "gold_category_kpis").drop("_gold_loaded_at"), *KPI_MONEY)


def incremental_top(spark, sf_dir):
    place = _followed(spark, sf_dir, "incremental_top")
    return doubles(read_gold(spark, place.gold, "gold_top_products").drop("_gold_loaded_at"), "price", "rating_rate")


def _registered(query: Query) -> Query:
    @wraps(query)
    def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
        name_scratch_locally(spark)
        return query(spark, sf_dir)

    return run_query


_QUERIES: dict[str, Query] = {
    "kpis": kpis,
    "top": top,
    "buckets": buckets,
    "q1": q1,
    "q2": q2,
    "q3": q3,
    "q4": q4,
    "q5": q5,
    "q6": q6,
    "card": card,
    "slicer": slicer,
    "value_share": value_share,
    "dedup": dedup,
    "required": required,
    "flags": flags,
    "flatten": flatten,
    "rejects": rejects,
    "upsert": upsert_union,
    "upsert_join": upsert_join,
    "key_history": key_history,
    "as_of": as_of,
    "category_tiers": category_tiers,
    "catalog_changes": catalog_changes,
    "catalog_applied": catalog_applied,
    "kpi_levels": kpi_levels,
    "sketch_spans": sketch_spans,
    "bronze_content": bronze_content,
    "landing": landing,
    "raw_scan": raw_scan,
    "raw_discovered": raw_discovered,
    "raw_day": raw_day,
    "bronze_append": bronze_append,
    "bronze_count": bronze_count,
    "silver": silver,
    "gold_kpis": gold_kpis,
    "serving_buckets": serving_buckets,
    "report_sql": report_sql,
    "contract": contract,
    "late": late,
    "incremental": incremental,
    "incremental_silver": incremental_silver,
    "bronze_compacted": bronze_compacted,
    "incremental_gold": incremental_gold,
    "incremental_top": incremental_top,
    "incremental_late": incremental_late,
    "admitted": admitted,
    "incremental_fields": incremental_fields,
    "batch_fields": batch_fields,
    "raw_nested": raw_nested,
    "raw_mistyped": raw_mistyped,
    "raw_array": raw_array,
    "array_fields": array_fields,
    "landing_stamped": landing_stamped,
    "bronze_overwrite": bronze_overwrite,
    "silver_flags": silver_flags,
    "rejects_stored": rejects_stored,
    "load_times": load_times,
    "replay": replay,
}

QUERIES: dict[str, Query] = {name: _registered(query) for name, query in _QUERIES.items()}
