import re
from collections import Counter
from fractions import Fraction
from math import comb

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from refinery.llm.quality_rules import CUTOFFS, RULES, binomial_tail, certify, judge, measure

COUNTS = ["n_words", "word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines", "n_stutters", "n_repeat_words"]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(re.findall("[A-Z]", text)),
        len(lines), len(lines) - len(set(lines)), sum(a == b for a, b in zip(words, words[1:])), len(covered),
    )


WORDS = st.lists(st.sampled_from(["a", "b", "C#", "ü", "\n", "\t x", " "]), max_size=60).map(" ".join)
ODD = ["", None, " \n\t ", "\n", "a" * 5000, "one two three four five six seven eight " * 2, "w " * 40_000, "a\x0bb\x0cc", "x\r\nx\r\n"]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(WORDS, min_size=30, max_size=40))
def test_counts_equal_brute_force(spark, documents, texts):
    texts = [*texts, *ODD]
    frame = documents(list(enumerate(texts)), n_words="x", _words="y", _ranked="z")
    rows = measure(frame).select("doc_id", *COUNTS, "base_failed").collect()
    for row in rows:
        expected = brute(texts[row.doc_id])
        assert tuple(row)[1:9] == expected
        assert row.base_failed == (expected[0] < 20 or 100 * expected[7] > 30 * expected[0])


def test_binomial_tail_is_exact(spark):
    cases = [(n, k, p) for p in (0.01, 0.05) for n, k in [(1, 0), (50, 0), (400, 1), (3000, 10), (3000, 29), (500, 24), (10, 9)]]
    for p in (0.01, 0.05):
        chosen = [(n, k) for n, k, q in cases if q == p]
        frame = spark.createDataFrame(chosen, "n bigint, k bigint")
        for n, k, tail in frame.select("n", "k", binomial_tail(F.col("n"), F.col("k"), p)).collect():
            q = Fraction(p)
            exact = float(sum(comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(k + 1)))
            assert tail == pytest.approx(1.0 if k >= n * p else exact, rel=1e-9)


def test_binomial_tail_of_large_samples(spark):
    [row] = spark.createDataFrame([(2_000_000, 19_000)], "n bigint, k bigint").select(binomial_tail(F.col("n"), F.col("k"), 0.01).alias("p")).collect()
    assert 1e-13 < row.p < 1e-11  # a normal tail at -7.1 standard deviations is 6e-13


GOOD = " ".join(f"word{i} and so on, a plain text" for i in range(10))
JUNK = " ".join(f"w{i}### $$$ off%%%" for i in range(30))


def labelled(spark, n_good=800, n_bad=100, odd=0):
    rows = [(i, f"{GOOD} {i}", "en") for i in range(n_good)] + [(10_000 + i, f"{JUNK} {i}", "en") for i in range(n_bad)]
    rows += [(20_000 + i, f"{JUNK} {i}", "en") for i in range(odd)]
    labels = [(i, 1) for i in range(n_good)] + [(10_000 + i, 0) for i in range(n_bad)] + [(20_000 + i, 1) for i in range(odd)]
    return (
        spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, lang string, kept string"),
        spark.createDataFrame(labels, "doc_id bigint, quality int"),
    )


def test_certified_cutoffs_reject_junk_and_keep_good(spark):
    documents, labels = labelled(spark)
    rows = judge(documents, labels).collect()
    assert {r.doc_id for r in rows if not r.kept} == {10_000 + i for i in range(100)} and len(rows) == 900


def test_too_few_labels_or_too_many_false_rejections_certify_nothing(spark):
    documents, labels = labelled(spark, n_good=50)
    assert certify(measure(documents), labels).count() == 0
    assert all(r.kept for r in judge(documents, labels).collect())
    documents, labels = labelled(spark, odd=40)
    found = {r.rule for r in certify(measure(documents), labels).collect()}
    assert "symbols" not in found


def test_strata_are_certified_one_by_one(spark):
    documents, labels = labelled(spark)
    other = documents.limit(0).unionByName(spark.createDataFrame(
        [(30_000, JUNK, "xx", ""), (30_001, JUNK, None, ""), (30_002, None, "en", ""), (None, JUNK, "en", ""), (10_000, JUNK, "en", "")],
        documents.schema))
    rows = judge(documents.unionByName(other), labels).collect()
    kept = {(r.doc_id, r.lang): r.kept for r in rows if r.doc_id is None or r.doc_id >= 10_000}
    assert kept[30_000, "xx"] and kept[30_001, None] and not kept[30_002, "en"] and not kept[None, "en"]
    assert sum(r.doc_id == 10_000 for r in rows) == 2


def test_a_true_rate_above_the_limit_is_rarely_certified(spark):
    """Simulated holdouts in which a fifth more good documents than the limit look bad."""
    draws = spark.range(400).selectExpr("id", "1000L AS n").withColumn(
        "k", F.expr("aggregate(sequence(1, 1000), 0L, (a, i) -> a + IF(pmod(xxhash64(id, i), 1000) < 12, 1, 0))"))
    [row] = draws.select(F.avg((binomial_tail(F.col("n"), F.col("k"), 0.01) <= 0.05).cast("int")).alias("rate"), F.avg("k").alias("k")).collect()
    assert row.rate <= 0.05 and row.k > 10


def test_no_rows(spark):
    documents, labels = labelled(spark)
    assert judge(documents.limit(0), labels).count() == 0
    assert judge(documents, labels.limit(0)).where("kept").count() == 900
    assert list(CUTOFFS) == sorted(CUTOFFS, reverse=True) and all(len(r) == 2 for r in RULES.values())
