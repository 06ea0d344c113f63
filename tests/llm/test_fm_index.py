"""Occurrences, spans and cut texts against plain string search."""

import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from refinery.llm.fm_index import Shard, build_index, build_shard, covered_words, find_phrases, suffix_order, without_spans

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(text, items, window):
    found, hit, names = words(text), set(), set()
    for name, phrase in items:
        phrase = words(phrase)
        size = min(window, len(phrase))
        grams = {tuple(phrase[i : i + size]) for i in range(len(phrase) - size + 1)} if size else set()
        for i in range(len(found) - size + 1):
            if tuple(found[i : i + size]) in grams:
                names.add("" if name is None else str(name))
                hit.update(range(i, i + size))
    return len(found), sorted(hit), sorted(names)


def spread(starts, ends):
    assert all(a < b for a, b in zip(starts, ends)) and all(b < a for a, b in zip(starts[1:], ends))
    return [place for a, b in zip(starts, ends) for place in range(a, b)]


def run(spark, rows, items, window=10, **options):
    frame = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id bigint, text string, text_key string, n_words int")
    asked = spark.createDataFrame([(*i, "z") for i in items], "item_id bigint, text string, words string")
    shard = options.pop("shard_words", 1 << 19)
    return frame, find_phrases(build_index(frame, shard_words=shard), asked, window=window, **options)


def check(found, rows, items, window):
    got = sorted(((r.doc_id, r.n_words, spread(r.starts, r.ends), list(r["items"])) for r in found.collect()), key=repr)
    assert got == sorted(((d, *brute(t, items, window)) for d, t in rows), key=repr)


PASSAGE = "It is a Truth universally acknowledged that a single man in possession of a good fortune must be in want"
ITEMS = [
    (1, PASSAGE), (2, "short one"), (3, None), (4, " .!"), (10, PASSAGE.upper()), (None, "nameless item"), (2, "another text of two"),
    (5, "x " * 40), (6, "été à la Plage"), (7, "x x x"),
]
ROWS = [
    (0, PASSAGE), (1, "before, " + PASSAGE + " after"), (2, None), (3, ""), (4, "!?"), (5, PASSAGE.replace(" ", "\n") * 2),
    (6, "a SHORT-one a short two"), (7, "x " * 100), (8, "x " * 5), (9, "ÉTÉ été à la plage"), (10, " ".join(PASSAGE.split()[3:14])),
    (11, " ".join(PASSAGE.split()[3:12])), (11, "short one"), (11, "short one"), (None, "Nameless  Item"), (None, None),
    (12, "w " * 60_000 + PASSAGE + " w" * 10), (13, "\x00short\x7fone "), (14, "日本 short one 語"),
]


@pytest.mark.parametrize("shard_words, block_words", [(1 << 19, 1 << 20), (30, 8)])
def test_spans_and_items(spark, shard_words, block_words):
    _, found = run(spark, ROWS, ITEMS, shard_words=shard_words, block_words=block_words)
    check(found, ROWS, ITEMS, 10)
    hits = found.select(covered_words().alias("n"), "starts", "ends").collect()
    assert all(r.n == len(spread(r.starts, r.ends)) for r in hits)


@settings(max_examples=30, deadline=None)
@given(
    docs=st.lists(st.lists(st.integers(0, 3), max_size=40), min_size=1, max_size=12),
    phrases=st.lists(st.lists(st.integers(0, 4), min_size=1, max_size=6), min_size=1, max_size=8),
)
def test_backward_search_and_locate(docs, phrases):
    lengths = np.array([len(d) for d in docs])
    flat = np.array([w for d in docs for w in d], np.uint64) * np.uint64(1 << 60)
    shard = Shard(int((lengths + (lengths > 0)).sum()), lengths, **build_shard(flat, lengths))
    for phrase in phrases:
        symbols = shard.numbers(np.array(phrase, np.uint64) * np.uint64(1 << 60))[None, :]
        _, first, end = shard.search(symbols)
        rows = np.concatenate([np.arange(a, b) for a, b in zip(first, end)]) if len(first) else np.empty(0, np.int64)
        found = sorted(shard.locate(rows).tolist())
        expected = [
            int(shard.doc_starts[d]) + i
            for d, doc in enumerate(docs) for i in range(len(doc) - len(phrase) + 1) if doc[i : i + len(phrase)] == phrase
        ]
        assert found == sorted(expected)


def test_order_of_suffixes_with_long_ties():
    block = [5, 6, 7, 5, 6] * 300
    symbols = np.array([*block, 0, *block, 1, *block, 2, 7, 3])
    order = suffix_order(symbols, 8)
    whole = symbols.tolist()
    assert order.tolist() == sorted(range(len(whole)), key=lambda i: whole[i:])
    # Keys that do not fit into 64 bits beside the place are sorted the other way.
    wide = np.array([*range(3000, 0, -1), 0])
    assert suffix_order(wide, 1 << 62).tolist() == list(range(3000, -1, -1))


def test_texts_without_spans(spark):
    frame, found = run(spark, ROWS, ITEMS)
    cut = without_spans(frame, found)
    assert cut.schema == frame.schema
    texts = {r.doc_id: r.text for r in cut.collect() if r.doc_id not in (None, 11)}
    assert texts[1] == "before,  after" and texts[0] == "" and texts[2] is None and texts[4] == "!?"
    assert texts[14] == "日本  語" and texts[9] == "ÉTÉ " and texts[6] == "a  a short two"
    assert texts[12] == "w " * 60_000 + " w" * 10
    nameless = sorted((r.text for r in cut.collect() if r.doc_id is None), key=repr)
    assert nameless == ["", None]
    assert [r.text for r in cut.where("doc_id = 11").collect()].count("") == 2


def test_empty_tables(spark):
    assert run(spark, [], ITEMS)[1].count() == 0
    _, found = run(spark, ROWS, [])
    check(found, ROWS, [], 10)
