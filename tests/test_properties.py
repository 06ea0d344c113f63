"""Invariants over generated inputs, checked against plain Python."""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings, strategies as st

from refinery.operators import accepted, label_rejects, rejected
from refinery.operators.rejects import usable
from refinery.plans import category_kpis, clean, price_buckets, top_products
from refinery.plans.silver import conform

COLUMNS = (
    "id string, title string, price string, category string, rating struct<rate:string,count:string>, _ingested_at string"
)
STAMPS = [f"2026-05-0{n}T00:00:00+00:00" for n in range(1, 5)]
TEXT = st.sampled_from(["a", " B ", "", "  ", "\tc"])
ROW = st.tuples(
    st.one_of(st.none(), st.sampled_from(["1", "2", "3", "4.0", "x"])),
    st.one_of(st.none(), TEXT),
    st.one_of(st.none(), st.sampled_from(["-1", "0", "24.99", "25", "74.995", "200", "1e12", "n/a"])),
    st.one_of(st.none(), TEXT),
    st.one_of(st.none(), st.tuples(st.sampled_from(["1.5", "4", None]), st.sampled_from(["10", "60", None]))),
    st.sampled_from(STAMPS),
)
QUICK = dict(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(**QUICK)
@given(rows=st.lists(ROW, max_size=14))
def test_layers(spark, rows):
    bronze = spark.createDataFrame(rows, COLUMNS)
    labelled = label_rejects(bronze)
    assert accepted(labelled).count() + rejected(labelled).count() == len(rows)

    same = ["id", "title", "price", "category", "_ingested_at"]
    assert sorted(map(str, usable(bronze).select(same).collect())) == sorted(
        map(str, accepted(labelled).select(same).collect())
    )

    taken = [
        r for r in rows
        if None not in r[:4] and r[0] != "x" and r[2] not in ("n/a", "1e12")
    ]
    newest = {}
    for r in taken:
        key = int(float(r[0]))
        newest[key] = max(newest.get(key, ""), r[5])
    silver = clean(bronze).cache()
    stored = silver.collect()
    assert {r.id: r._ingested_at for r in stored} == newest and len(stored) == len(newest)
    conformed = {(r.id, r.title, r.price, r._ingested_at) for r in conform(accepted(labelled)).collect()}
    assert {(r.id, r.title, r.price, r._ingested_at) for r in stored} <= conformed

    buckets = price_buckets(silver).collect()
    assert sum(r.product_count for r in buckets) == len(stored)
    valid = [r for r in stored if r.price > 0 and r.title]
    kpis = category_kpis(silver).collect()
    assert sum(r.product_count for r in kpis) == len(valid)
    assert sum((r.total_inventory_value for r in kpis), Decimal(0)) == sum((r.price for r in valid), Decimal(0))

    eligible = [r for r in valid if (r.rating_count or 0) >= 50]
    order = lambda r: (-(r.rating_rate if r.rating_rate is not None else -1.0), -r.rating_count, r.id)
    expected = [r.id for r in sorted(eligible, key=order)][:2]
    assert [r.id for r in top_products(silver, n=2).collect()] == expected
    silver.unpersist()
