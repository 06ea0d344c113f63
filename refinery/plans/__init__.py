from refinery.plans.bronze import merge_schema, verify_bronze, write_bronze
from refinery.plans.gold import category_kpis, price_buckets, top_products, write_gold
from refinery.plans.landing import land_records, stamped
from refinery.plans.serving import export_tables, serve_views
from refinery.plans.silver import clean, conform, refine, write_silver

__all__ = [
    "category_kpis",
    "clean",
    "conform",
    "export_tables",
    "land_records",
    "merge_schema",
    "price_buckets",
    "refine",
    "serve_views",
    "stamped",
    "top_products",
    "verify_bronze",
    "write_bronze",
    "write_gold",
    "write_silver",
]
