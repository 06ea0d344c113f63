"""Outputs against a plain regular expression, and exact round trips."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from refinery.llm import fill_middle
from refinery.llm.fill_middle import CutFinder, fill_in_middle, restored, starts


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.DOTALL)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted(x % (n + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ODD = [
    None, "", "a", "\n", "<P>x", "a<S>b", "<M>", "<", "<<P", "S><M", "<S", "ü日本🙂é", "\r\n x\x85", "<" * 50, "word " * 30_000,
    "A" * 20_000, "é" * 9_000, "a" * 4095 + "é" + "b" * 4096, "$1 \\ $2",
]


def check(frame, rows):
    found = fill_in_middle(frame).withColumn("again", restored(F.col("output"), F.col("form"))).collect()
    made = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found), key=repr)
    assert made == sorted(((d, *brute(d, t)) for d, t in rows), key=repr)
    texts = sorted((r.doc_id, r.again) for r in found if r.doc_id is not None)
    assert texts == sorted((d, t or "") for d, t in rows if d is not None)


def test_odd_texts(spark, documents):
    rows = [(100 * i + k, text) for i, text in enumerate(ODD) for k in range(12)]
    rows += [(None, "some text here"), (None, None), (5, "other"), (5, "other"), (5, "another"), (-3, "x y z")]
    check(documents(rows, n="n", form="plain", output="o"), rows)
    assert {brute(d, t)[1] for d, t in rows} == {"plain", "psm", "spm"}


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(st.sampled_from("aZ <>PSM\n.é日🙂"), max_size=60), min_size=20, max_size=60))
def test_any_texts(spark, documents, texts):
    check(documents(list(enumerate(texts))), list(enumerate(texts)))


def test_empty_table(spark, documents):
    assert fill_in_middle(documents([(1, "x")]).limit(0)).count() == 0


@pytest.mark.parametrize("block", [1, 2, 3, 7, 4096])
def test_every_cut_by_the_tree(monkeypatch, block):
    monkeypatch.setattr(fill_middle, "BLOCK", block)
    text = "The Größe of 日本, abcdefghijklmnop! 🙂\n" * 3
    data = np.frombuffer(text.encode(), np.uint8)
    finder = CutFinder(*starts(data, np.array([0, len(data)])))
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.DOTALL)
    for k in range(len(units) + 1):
        before = "".join(units[:k])
        assert finder.cut(k) == (len(before.encode()), len(before))
