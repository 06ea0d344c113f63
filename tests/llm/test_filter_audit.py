"""Every order of the filters, applied one after the other to the documents themselves."""

import re
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from refinery.llm.filter_audit import FILTERS, audit, mask_cells, walk

LONG = " ".join(f"w{i}" for i in range(230))
TEXTS = [
    None, "", " \n", "short", "# short", LONG, LONG, LONG + " #", LONG.upper(), "w " * 250, "w " * 250, "W " * 300 + "|",
    " ".join(f"w{i % 100}" for i in range(200)), " ".join(f"w{i % 99}" for i in range(200)), "\x0b".join(f"w{i}" for i in range(201)),
    "A" * 3 + "a" * 97, "A" * 4 + "a" * 96, "é" * 5000, "ok ok OK",
]


def fails(rows):
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    found = []
    for doc_id, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        checks = [
            len(words) < 200, 100 * len(set(words)) < 50 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search("[#$%&*|]", text)),
            doc_id is not None and doc_id > least[text],
        ]
        found.append((doc_id, lang or "", {f for f, failed in zip(FILTERS, checks) if failed}))
    return found


def brute(rows, good, toxic):
    judged, out = fails(rows), []
    for part in sorted({p for _, p, _ in judged}):
        mine = [(d, f) for d, p, f in judged if p == part]
        steps = []
        for order in permutations(FILTERS):
            left = mine
            for number, letter in enumerate(order, 1):
                gone = [(d, f) for d, f in left if letter in f]
                left = [(d, f) for d, f in left if letter not in f]
                steps.append((
                    "".join(order), number, len(left), len(gone), sum(letter in f for _, f in mine) - len(gone),
                    sum(f == {letter} for _, f in mine), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone),
                ))
        shapley = {x: sum(s[3] for s in steps if s[0][s[1] - 1] == x) for x in FILTERS}
        out += [(part, *s, shapley[s[0][s[1] - 1]]) for s in steps]
    return sorted(out)


def run(spark, rows, said):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, lang string, words string, n int")
    labels = spark.createDataFrame([(*s, "y") for s in said], "doc_id bigint, quality int, toxic int, text string")
    return sorted(tuple(r) for r in audit(mask_cells(frame, labels)).collect())


def test_equals_filters_applied_in_order(spark):
    langs = ["en", None, "", "de", "en"]
    rows = [(i, text, langs[i % 5]) for i, text in enumerate(TEXTS * 3)]
    # Null ids, repeated ids with one text and with two, and an id below all others.
    rows += [(None, LONG, "en"), (None, LONG, "en"), (7, TEXTS[7], "de"), (7, "short", "fr"), (-5, LONG, "it"), (-5, LONG, "it")]
    said = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 50, 2)]
    said += [(4, 1, None), (None, 1, 1), (9, None, 1), (9, 0, None), (-5, 1, 1), (1000, 1, 1)]
    good, toxic = ({s[0] for s in said if s[0] is not None and s[k] == 1} for k in (1, 2))
    assert run(spark, rows, said) == brute(rows, good, toxic)


def test_no_documents_and_no_labels(spark):
    assert run(spark, [], []) == []
    found = run(spark, [(1, None, None)], [])
    assert len(found) == 600 and {r[0] for r in found} == {""}
    assert found == brute([(1, None, None)], set(), set())


def test_walk_equals_each_subset_counted_anew():
    rng = np.random.default_rng(3)
    masks, weights = rng.integers(0, 64, 40), rng.integers(0, 9, (40, 3))
    states = walk(masks, weights, 6)
    for subset in range(64):
        assert (states[subset] == weights[(masks & subset) == 0].sum(axis=0)).all()


def test_texts_are_counted_before_they_meet(spark):
    rows = spark.range(10_000).select(F.col("id").alias("doc_id"), F.lit(LONG).alias("text"), F.lit("en").alias("lang"))
    cells = mask_cells(rows, spark.createDataFrame([], "doc_id bigint, quality int, toxic int")).collect()
    assert sorted((c["mask"], c["n"]) for c in cells) == [(0, 1), (16, 9_999)]
