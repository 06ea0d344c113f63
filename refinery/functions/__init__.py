from refinery.functions.columns import (
    has_rating,
    instant,
    is_absent,
    is_text,
    is_valid,
    normalized,
    sortable_values,
    tier,
    tier_position,
    to_decimal,
    to_double,
    to_whole_number,
    total_order,
    utc_date,
    utc_stamp,
)

__all__ = [
    "has_rating",
    "instant",
    "is_absent",
    "is_text",
    "is_valid",
    "normalized",
    "sortable_values",
    "tier",
    "tier_position",
    "to_decimal",
    "to_double",
    "to_whole_number",
    "total_order",
    "utc_date",
    "utc_stamp",
]
