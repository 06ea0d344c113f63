import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from refinery.llm.packing import WordIds, _best_fit_decreasing, pack, pack_documents, pack_lengths

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def word_ids():
    return WordIds(PATH)


def library(texts):
    return [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


PIECES = ["it's", "'Sound", "we'LL", "<|endoftext|>", "É’s", "Straße", "İstanbul", "5×3", "½", "\x85", "ΟΔΟΣ", "é", "日本", " \n", "a_b", "''t", "12"]


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=5)), max_size=8).map(" ".join), min_size=1, max_size=5))
def test_ids_equal_the_library(word_ids, texts):
    found = {i: ids.tolist() for i, ids in word_ids.rows(pa.array(texts))}
    assert [found[i] for i in range(len(texts))] == library(texts)


@settings(max_examples=100, deadline=None)
@given(lengths=st.lists(st.integers(1, 64), max_size=60))
def test_every_item_has_its_place(lengths):
    bins, offsets = pack_lengths(np.array(lengths, np.int64), 64)
    for b in set(bins.tolist()):
        inside = sorted((offsets[i], lengths[i]) for i in np.flatnonzero(bins == b))
        ends = np.cumsum([n for _, n in inside])
        assert [o for o, _ in inside] == [0, *ends[:-1]] and ends[-1] <= 64
    assert sorted(set(bins.tolist())) == list(range(len(set(bins.tolist()))))
    if lengths:
        assert bins.max() <= _best_fit_decreasing(np.array(lengths), 64).max()


def test_swaps_empty_bins_that_best_fit_leaves():
    lengths = np.random.default_rng(0).integers(400, 800, 3000)
    first = int(_best_fit_decreasing(lengths, 2048).max()) + 1
    least = -(-int(lengths.sum()) // 2048)
    found = int(pack_lengths(lengths)[0].max()) + 1
    assert least <= found < first and (found - least) < 0.7 * (first - least)


def test_lengths_out_of_range():
    for bad in (0, 65):
        with pytest.raises(ValueError):
            pack_lengths(np.array([bad]), 64)


def test_pieces_and_sequences(spark, documents):
    long = "word another third " * 2500
    texts = {1: "Hello there", 2: None, 3: "", 4: long, 5: "it's 5×3 <|endoftext|> x", 6: "ΟΔΟΣ"}
    rows = [*texts.items(), (6, "ΟΔΟΣ"), (None, "a b c")]
    found = pack_documents(documents(rows, piece="x", offset="y", length="z"), PATH).collect()
    ids = {k: [*library([t or ""])[0], 0] for k, t in texts.items()}
    pieces = {}
    for r in found:
        pieces.setdefault(r.doc_id, []).append(r)
    for k, expected in ids.items():
        for r in pieces[k]:
            part = np.array(expected[r.start : r.start + r.length], "<u4")
            assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32 and r.start == 2048 * r.piece
    assert sorted(r.piece for r in pieces[4]) == list(range(-(-len(ids[4]) // 2048)))
    assert len(pieces[6]) == 2 and pieces[2][0].length == pieces[3][0].length == 1 and len(pieces[None]) == 1
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for inside in places.values():
        inside.sort()
        assert [o for o, _ in inside] == [0, *np.cumsum([n for _, n in inside])[:-1]] and sum(n for _, n in inside) <= 2048
    assert pack_documents(documents([]), PATH).count() == 0


def check_places(found, capacity):
    found = found.sort_values(["sequence_id", "offset"])
    ends = found.groupby("sequence_id")["length"].cumsum()
    assert (ends - found["length"] == found["offset"]).all() and ends.max() <= capacity


def test_groups_are_even_whatever_the_key(spark):
    pieces = spark.range(1000).selectExpr("7L AS doc_id", "1 AS piece", "id % 90 + 1 AS length")
    found = pack(pieces, capacity=100, group=100).toPandas()
    assert len(found) == 1000 and found["sequence_id"].floordiv(1 << 40).nunique() == 10
    check_places(found, 100)


def test_groups_come_near_one_group(spark):
    lengths = np.random.default_rng(1).integers(400, 800, 4000)
    pieces = spark.createDataFrame([(i, int(n), "x") for i, n in enumerate(lengths)], "doc_id bigint, length bigint, __fill string")
    whole, split = (pack(pieces, group=size).toPandas() for size in (10_000, 500))
    for found in (whole, split):
        assert sorted(found["doc_id"]) == list(range(4000))
        check_places(found, 2048)
    assert split["sequence_id"].nunique() <= 1.005 * whole["sequence_id"].nunique()
    assert split["sequence_id"].nunique() < _best_fit_decreasing(lengths, 2048).max() + 1


def best(lengths, capacity):
    """The least number of bins, by trying all places of the longest first."""
    lengths, found = sorted(lengths, reverse=True), [len(lengths)]

    def place(i, fills):
        if len(fills) >= found[0]:
            return
        if i == len(lengths):
            found[0] = len(fills)
            return
        for j in {fill: j for j, fill in enumerate(fills) if fill + lengths[i] <= capacity}.values():
            place(i + 1, [*fills[:j], fills[j] + lengths[i], *fills[j + 1 :]])
        place(i + 1, [*fills, lengths[i]])

    place(0, [])
    return found[0]


@settings(max_examples=60, deadline=None)
@given(lengths=st.lists(st.integers(1, 30), min_size=1, max_size=9))
def test_small_cases_need_no_more_than_one_bin_over_the_optimum(lengths):
    assert len(set(pack_lengths(np.array(lengths), 30)[0])) <= best(lengths, 30) + 1


def test_no_pieces(spark):
    assert pack(spark.createDataFrame([], "doc_id bigint, length bigint"), group=5).count() == 0
