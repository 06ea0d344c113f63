"""The same chain over a table with other column names."""

from pyspark.sql import types as T

from records import DAY1, write_lines
from refinery import Roles
from refinery.contracts import SERVING
from refinery.plans.medallion import Layout, run, run_new
from refinery.sources import read_gold, read_silver

ROLES = Roles(
    key="sku", title="name", price="amount", description="notes", category="kind", rating="stars",
    rate_field="mean", count_field="votes", key_type="bigint", price_type="decimal(12,3)",
    min_reviews=5, top_n=1, tier_bounds=(10,), tier_labels=("low", "high"),
)
STARS = T.StructType([T.StructField("mean", T.StringType()), T.StructField("votes", T.StringType())])
SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("sku", "name", "amount", "notes", "kind", "_ingested_at")]
    + [T.StructField("stars", STARS)]
)


def rows():
    for n in range(4):
        yield {
            "sku": 2**40 + n, "name": f" n{n} ", "amount": 9.999 + n, "kind": " K ", "notes": " x ",
            "stars": {"mean": 3 + n / 2, "votes": 4 + n}, "_ingested_at": f"{DAY1}T00:00:00+00:00",
        }


def check(spark, place):
    silver = read_silver(spark, place.silver, roles=ROLES).orderBy("sku").collect()
    assert [(r.sku, r["name"], str(r.amount), r.notes, r.kind) for r in silver][0] == (2**40, "n0", "9.999", "x", "k")
    [kpi] = read_gold(spark, place.gold, "gold_category_kpis").collect()
    assert (kpi.category, kpi.product_count, kpi.total_reviews) == ("k", 4, 22)
    [top] = read_gold(spark, place.gold, "gold_top_products").collect()
    assert (top.id, top.title, top.rating_rate) == (2**40 + 3, "n3", 4.5)
    buckets = read_gold(spark, place.gold, "gold_price_buckets").collect()
    assert {r.price_bucket: r.product_count for r in buckets} == {"low": 1, "high": 3}


def test_batch(spark, root):
    write_lines(root + "/raw", DAY1, "a.json", rows())
    done = run(spark, root, schema=SCHEMA, roles=ROLES)
    assert set(done.exported) == set(SERVING)
    check(spark, Layout(root))


def test_incremental(spark, root):
    write_lines(root + "/raw", DAY1, "a.json", list(rows())[:2])
    run_new(spark, root, schema=SCHEMA, roles=ROLES)
    write_lines(root + "/raw", DAY1, "b.json", list(rows())[1:])
    run_new(spark, root, schema=SCHEMA, roles=ROLES)
    check(spark, Layout(root))
