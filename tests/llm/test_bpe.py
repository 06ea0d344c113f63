import random

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from refinery.llm import bpe_automaton
from refinery.llm.bpe_automaton import TokenAutomaton, byte_bpe, encode_decode

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


TEXT = st.one_of(
    st.text(max_size=40),
    st.text(alphabet="abetinorsT '\n\t.,!019-_é🙂  \u0085 ", max_size=60),
    st.lists(st.sampled_from(["<|endoftext|>", "the", " ", "\n\n", "aaaa", "'ll", "’s", "1234"]), max_size=10).map("".join),
)


@settings(max_examples=300, deadline=None)
@given(text=TEXT)
def test_ids_and_texts_equal_the_library(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    bpe = byte_bpe(PATH)
    found = bpe.encode(text)
    assert np.frombuffer(found, "<u4").tolist() == ids
    assert bpe.decode(found) == library.decode(ids, skip_special_tokens=False)


def merge_by_merge(word, ranks):
    tokens = [bytes([b]) for b in word]
    while True:
        pairs = [(ranks[p], i) for i, p in enumerate(zip(tokens, tokens[1:])) if p in ranks]
        if not pairs:
            return tokens
        _, i = min(pairs)
        tokens[i : i + 2] = [tokens[i] + tokens[i + 1]]


@pytest.mark.parametrize("seed", range(25))
def test_automaton_equals_merging_one_by_one(seed):
    """Random merges in which every token is made in one way only, by its own tokenization."""
    draw = random.Random(seed)
    tokens, ranks = [b"a", b"b", b"c"], {}
    for _ in range(200):
        left, right = draw.choice(tokens), draw.choice(tokens)
        made = left + right
        if len(made) <= 9 and made not in tokens and merge_by_merge(made, ranks) == [left, right]:
            ranks[left, right] = len(ranks)
            tokens.append(made)
    number = {t: i for i, t in enumerate(tokens)}
    merges = [(number[a], number[b], number[a + b]) for a, b in ranks]
    automaton = TokenAutomaton(dict(enumerate(tokens)), merges)
    for _ in range(150):
        word = bytes(draw.choice(b"abc") for _ in range(draw.randint(0, 30)))
        assert [tokens[t] for t in automaton.encode(word)] == merge_by_merge(word, ranks)


def test_a_byte_without_token_is_an_error():
    with pytest.raises(ValueError):
        TokenAutomaton({0: b"a"}, []).encode(b"ab")


def test_words_are_remembered_in_two_generations(library, monkeypatch):
    monkeypatch.setattr(bpe_automaton, "REMEMBERED", 3)
    bpe = bpe_automaton.ByteBpe(PATH)
    text = " one two three four one five six one seven two eight two nine one" * 3
    assert np.frombuffer(bpe.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(bpe.words) <= 3 and len(bpe.words.older) == 3


def test_merges_out_of_order_are_refused():
    labels = {0: b"a", 1: b"b", 2: b"ab", 3: b"aba"}
    with pytest.raises(ValueError):
        TokenAutomaton(labels, [(2, 0, 3), (0, 1, 2)])
    with pytest.raises(ValueError):
        TokenAutomaton(labels, [(0, 0, 2)])


def test_edge_rows(spark, documents, library):
    texts = {1: "Hello <|endoftext|> world", 2: None, 3: "", 4: "long text, " * 20_000, 5: "=" * 5000}
    rows = [*texts.items(), (5, "x"), (None, "y")]
    found = encode_decode(documents(rows, ids="a", decoded="b"), PATH).collect()
    assert len(found) == 7
    for r in found:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        if r.doc_id in texts and r.decoded != "x":
            assert r.decoded == (texts[r.doc_id] or "") and ids == library.encode(r.decoded, add_special_tokens=False).ids
    assert encode_decode(documents([]), PATH).count() == 0
