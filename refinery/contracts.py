"""Schemas of the layers, and a check that holds a DataFrame to one of them.

Column names and types below are fixed values: the serving tables and the raw
records are read by other programs under exactly these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Raw and bronze: scalars as text, so that a value that is no number survives until
# silver decides, and so that no file changes the schema of another.
RAW = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField(
            "rating",
            T.StructType(
                [T.StructField("rate", T.StringType()), T.StructField("count", T.StringType())]
            ),
        ),
        T.StructField("_ingested_at", T.StringType()),
    ]
)

BRONZE_AUDIT = T.StructType(
    [
        T.StructField("_corrupt_record", T.StringType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField("_bronze_loaded_at", T.TimestampType()),
    ]
)


def bronze_schema(raw: T.StructType = RAW) -> T.StructType:
    """Columns of a bronze table loaded under the given raw schema."""
    return T.StructType(raw.fields + BRONZE_AUDIT.fields)


BRONZE = bronze_schema()

SILVER = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("price", T.DecimalType(10, 2)),
        T.StructField("description", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("rating_rate", T.DoubleType()),
        T.StructField("rating_count", T.IntegerType()),
        T.StructField("has_rating", T.BooleanType()),
        T.StructField("is_valid", T.BooleanType()),
        T.StructField("_ingested_at", T.StringType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField("_bronze_loaded_at", T.TimestampType()),
        T.StructField("_silver_loaded_at", T.TimestampType()),
    ]
)

# Whole numbers are 64 bits wide here: a count over a large table outgrows 32.
CATEGORY_KPIS = T.StructType(
    [
        T.StructField("category", T.StringType(), False),
        T.StructField("product_count", T.LongType(), False),
        T.StructField("avg_price", T.DecimalType(10, 2)),
        T.StructField("min_price", T.DecimalType(10, 2)),
        T.StructField("max_price", T.DecimalType(10, 2)),
        # As wide as Spark makes the sum of decimal(10,2); a narrower database asks for its own type.
        T.StructField("total_inventory_value", T.DecimalType(20, 2)),
        T.StructField("avg_rating", T.DecimalType(4, 2)),
        T.StructField("total_reviews", T.LongType()),
        T.StructField("_gold_loaded_at", T.TimestampType()),
    ]
)

TOP_PRODUCTS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("title", T.StringType(), False),
        T.StructField("category", T.StringType(), False),
        T.StructField("price", T.DecimalType(10, 2)),
        T.StructField("rating_rate", T.DecimalType(4, 2)),
        T.StructField("rating_count", T.LongType()),
        T.StructField("_gold_loaded_at", T.TimestampType()),
    ]
)

PRICE_BUCKETS = T.StructType(
    [
        T.StructField("price_bucket", T.StringType(), False),
        T.StructField("product_count", T.LongType(), False),
        T.StructField("avg_price", T.DecimalType(10, 2)),
        T.StructField("_gold_loaded_at", T.TimestampType()),
    ]
)

SERVING = {
    "gold_category_kpis": CATEGORY_KPIS,
    "gold_top_products": TOP_PRODUCTS,
    "gold_price_buckets": PRICE_BUCKETS,
}


def silver_schema_of(roles) -> T.StructType:
    """The silver columns under the names and types that ``roles`` gives them."""
    names = {
        "id": roles.key,
        "title": roles.title,
        "price": roles.price,
        "description": roles.description,
        "category": roles.category,
        "_ingested_at": roles.ingested_at,
    }
    types = {"id": roles.key_type, "price": roles.price_type}
    return T.StructType(
        [
            T.StructField(
                names.get(f.name, f.name),
                T.DataType.fromDDL(types[f.name]) if f.name in types else f.dataType,
            )
            for f in SILVER.fields
        ]
    )


def widened(contract: T.StructType, **types: T.DataType) -> T.StructType:
    """A contract with other types for some columns, such as a wider total."""
    unknown = set(types) - set(contract.names)
    if unknown:
        raise ValueError(f"no such columns in the contract: {sorted(unknown)}")
    return T.StructType(
        [T.StructField(f.name, types.get(f.name, f.dataType), f.nullable) for f in contract.fields]
    )


def enforce_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """The contract's columns, in its order and types.

    Checked while the rows are written, not in a pass of its own: a NULL in a
    NOT NULL column, or a value that does not fit its type, fails the job. This does
    not depend on the session's ANSI setting. Missing columns fail at once.
    """
    missing = [name for name in contract.names if name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the contract: {missing}")
    return df.select(*[_held_to(field).alias(field.name) for field in contract.fields])


def _held_to(field: T.StructField) -> Column:
    raw = F.col(f"`{field.name}`")
    typed = raw.try_cast(field.dataType)
    misfit = F.concat(
        F.lit(f"{field.name}: does not fit {field.dataType.simpleString()}: "), raw.cast("string")
    )
    checked = F.when(raw.isNotNull() & typed.isNull(), F.raise_error(misfit)).otherwise(typed)
    if field.nullable:
        return checked
    checked = F.when(raw.isNull(), F.raise_error(F.lit(f"{field.name}: NULL not allowed"))).otherwise(checked)
    # The default is never reached; it only lets Spark see that the column has no NULLs,
    # which the JDBC writer turns into NOT NULL.
    unreached = "" if isinstance(field.dataType, T.StringType) else 0
    return F.coalesce(checked, F.lit(unreached).cast(field.dataType))
