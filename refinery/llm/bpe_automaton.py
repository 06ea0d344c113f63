"""Byte-level BPE as a deterministic automaton over tokens, compiled merge by merge into a table.

The automaton starts with one arc per byte and accepts every byte string. Each merge (u, v) -> w
adds a gadget: the state behind u loses its arc v; a new state for w starts as a copy of the state
behind v as it was before; and every state that still has an arc u gets an arc w. After all merges
a path is accepted if, and only if, it is the tokenization of its bytes.

States are kept in a list in which a copy stands right after its original, and so are arcs. All
later copies of a state, and theirs, then lie between it and what followed it when the gadget was
added: what a gadget removes, together with what inherits that, is a rectangle of states and arcs.
The table of transitions is the union of all rectangles, one bit for each class of states and class
of arcs that no gadget tells apart.

Encoding runs once over the bytes of a pre-split word. A prefix of a BPE text is tokenized like
the text up to the last token, so each place of the word has exactly one state. A matching table
over the bytes names the arc labels that end at a place, and the table of transitions says which of
them leaves the state of the place where it begins: exactly one. Decoding emits arc labels.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

#: Fixed value: the pre-split of byte-level BPE.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts below this character are split by a pattern of explicit ranges, which is faster.
NEAR = 0x250
#: Words a worker remembers in each of two generations, and the longest it remembers.
REMEMBERED, LONGEST = 300_000, 64


def byte_letters() -> dict[str, int]:
    """The letter by which vocabulary files write each byte: itself if printable, else 256 and up."""
    letters, extra = {}, 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            letters[chr(byte)] = byte
        else:
            letters[chr(extra)] = byte
            extra += 1
    return letters


def _ranges(property_name: str) -> str:
    """The characters below ``NEAR`` with a property, as ranges of a character class."""
    has = regex.compile(property_name).match
    found = [c for c in range(NEAR) if has(chr(c))]
    runs = np.split(np.array(found), np.flatnonzero(np.diff(found) > 1) + 1)
    return "".join(f"{re.escape(chr(r[0]))}-{re.escape(chr(r[-1]))}" for r in runs)


def near_split() -> re.Pattern:
    """``SPLIT`` for texts whose characters all lie below ``NEAR``."""
    letter, number, space = (_ranges(p) for p in (r"\p{L}", r"\p{N}", r"\s"))
    return re.compile(
        f"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+"
    )


#: States whose transitions are laid out at a time while the table is built.
ROWS = 512
#: Steps of the matching table, besides those of the trie, that are kept once known.
STEPS = 500_000


class _Copies:
    """A list in which each copy stands right after its original."""

    def __init__(self, originals: list[int]):
        self.after = dict(zip(originals, [*originals[1:], -1]))
        self.first = originals[0] if originals else -1

    def copy(self, original: int, made: int) -> None:
        self.after[made] = self.after[original]
        self.after[original] = made

    def places(self) -> dict[int, int]:
        found, item = {}, self.first
        while item >= 0:
            found[item] = len(found)
            item = self.after[item]
        found[-1] = len(found)
        return found


def _classes(places: dict[int, int], first: list[int], behind: list[int]) -> tuple[dict[int, int], np.ndarray, np.ndarray]:
    """The class of each item, and the classes from which and before which each gadget holds."""
    starts = np.array([places[i] for i in first], np.int64)
    ends = np.array([places[i] for i in behind], np.int64)
    bounds = np.unique(np.concatenate((starts, ends)))
    items = list(places)
    of = np.searchsorted(bounds, [places[i] for i in items], "right")
    return dict(zip(items, of.tolist())), np.searchsorted(bounds, starts) + 1, np.searchsorted(bounds, ends) + 1


class _Steps(dict):
    """(node << 8 | byte) -> node: the trie's steps; others follow the failure links and are remembered."""

    def close(self, fail: list[int]) -> None:
        self.fail, self.most = fail, len(self) + STEPS

    def __missing__(self, key: int) -> int:
        node, byte = key >> 8, key & 255
        found = 0
        while node:
            node = self.fail[node]
            found = self.get(node << 8 | byte, 0)
            if found:
                break
        if len(self) < self.most:
            self[key] = found
        return found


class TokenAutomaton:
    """Arcs are token ids, and the state behind an arc depends on its label alone.

    ``merges`` are (left, right, made) in the order of their ranks. Labels of several bytes that no
    merge makes are no arcs; of two merges that make one token the first counts.
    """

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int, int]]):
        singles = [token for token, label in labels.items() if len(label) == 1]
        states, arcs, made_yet = _Copies(singles), _Copies(singles), set(singles)
        lefts, rights, state_ends, arc_ends = [], [], [], []
        for rank, (left, right, made) in enumerate(merges):
            if labels[left] + labels[right] != labels[made]:
                raise ValueError(f"merge {rank} does not make its token")
            if left not in made_yet or right not in made_yet:
                raise ValueError(f"merge {rank} comes before its parts")
            new = made not in made_yet
            if new:
                states.copy(right, made)  # as it was before the gadget
            lefts.append(left)
            rights.append(right)
            state_ends.append(states.after[left])
            arc_ends.append(arcs.after[right])
            if new:
                arcs.copy(left, made)  # after the gadget has removed its arc
                made_yet.add(made)
        self.labels = {token: labels[token] for token in made_yet}
        state_class, top, bottom = _classes(states.places(), lefts, state_ends)
        arc_class, near, far = _classes(arcs.places(), rights, arc_ends)
        self._lay_out(top, bottom, near, far, max(state_class.values()) + 1, max(arc_class.values()) + 1)
        self._match({token: state_class[token] * self.width for token in self.labels}, arc_class)

    def _lay_out(self, top, bottom, near, far, states: int, arcs: int) -> None:
        """One bit a state and arc, set where a gadget has removed the arc: corners, summed both ways."""
        self.width = (arcs + 7) // 8
        rows, cols = np.concatenate((top, top, bottom, bottom)), np.concatenate((near, far, near, far))
        signs = np.repeat(np.array([1, -1, -1, 1], np.int32), len(top))
        order = np.argsort(rows, kind="stable")
        rows, cols, signs = rows[order], cols[order], signs[order]
        held, table = np.zeros(arcs + 1, np.int32), []
        for start in range(0, states, ROWS):
            part = np.zeros((min(ROWS, states - start), arcs + 1), np.int32)
            part[0] = held
            a, b = np.searchsorted(rows, (start, start + len(part)))
            np.add.at(part, (rows[a:b] - start, cols[a:b]), signs[a:b])
            np.cumsum(part, axis=0, out=part)
            held = part[-1].copy()
            np.cumsum(part, axis=1, out=part)
            table.append(np.packbits(part[:, :arcs] > 0, axis=1, bitorder="little").tobytes())
        self.removed = b"".join(table)

    def _match(self, state_at: dict[int, int], arc_class: dict[int, int]) -> None:
        """The byte trie of all labels with its failure links, and the labels that end at each node.

        A label is (token, size, byte of its arc in a state's bits, mask of its bit, state behind it),
        the longest first. The start is state 0, which has all arcs: no rectangle begins before 1.
        """
        self.step = _Steps()
        ends: list[tuple] = [()]
        for token, label in self.labels.items():
            node = 0
            for byte in label:
                key = node << 8 | byte
                if key not in self.step:
                    self.step[key] = len(ends)
                    ends.append(())
                node = self.step[key]
            ends[node] = ((token, len(label), arc_class[token] >> 3, 1 << (arc_class[token] & 7), state_at[token]),)
        below: dict[int, list[tuple[int, int]]] = {}
        for key, node in self.step.items():
            below.setdefault(key >> 8, []).append((key & 255, node))
        fail, level = [0] * len(ends), [0]
        self.step.close(fail)
        for _ in range(max(map(len, self.labels.values()), default=0)):
            for parent in level:
                for byte, node in below.get(parent, ()):
                    fail[node] = self.step[fail[parent] << 8 | byte] if parent else 0
                    ends[node] += ends[fail[node]]
            level = [node for parent in level for _, node in below.get(parent, ())]
        self.ends = ends

    def encode(self, word: bytes) -> list[int]:
        """The tokens of one pre-split word: one run over its bytes.

        Of the labels that end at a byte exactly one is an arc of the state where it begins.
        """
        step, ends, removed = self.step, self.ends, self.removed
        states, reached, node, place = [0], [-1], 0, 0
        for byte in word:
            place += 1
            node = step[node << 8 | byte]
            for token, size, at, mask, state in ends[node]:
                if not removed[states[place - size] + at] & mask:
                    states.append(state)
                    reached.append(token)
                    break
            else:
                raise ValueError("a byte of the text has no token")
        tokens, labels = [], self.labels
        while place:
            token = reached[place]
            tokens.append(token)
            place -= len(labels[token])
        return tokens[::-1]


class _Remembered(dict):
    """Ids of words, as little-endian bytes; a missing word is encoded.

    A full generation becomes the older one, from which words that come again are taken over.
    """

    def __init__(self, automaton: TokenAutomaton):
        super().__init__()
        self.automaton = automaton
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            tokens = self.automaton.encode(word.encode())
            ids = struct.pack(f"<{len(tokens)}I", *tokens)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class ByteBpe:
    """A byte-level BPE tokenizer read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, letters = described["model"], byte_letters()
        labels = {i: bytes(letters[c] for c in token) for token, i in model["vocab"].items() if all(c in letters for c in token)}
        pairs = [merge.split(" ") if isinstance(merge, str) else merge for merge in model["merges"]]
        ids = model["vocab"]
        self.special = {t["content"]: t["id"] for t in described.get("added_tokens", [])}
        plain = {i: label for i, label in labels.items() if i not in set(self.special.values())}
        self.automaton = TokenAutomaton(plain, [(ids[a], ids[b], ids[a + b]) for a, b in pairs])
        self.words = _Remembered(self.automaton)
        self.label = {**labels, **{i: content.encode() for content, i in self.special.items()}}
        self._split, self._near_split = regex.compile(SPLIT), near_split()
        self._far = re.compile(f"[{chr(NEAR)}-\U0010ffff]")
        longest_first = sorted(self.special, key=lambda s: (-len(s), s))
        self.marks = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.special else None

    def split(self, text: str) -> list[str]:
        far = not text.isascii() and self._far.search(text)
        return (self._split if far else self._near_split).findall(text)

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian 32-bit integers; strings of special tokens are those tokens."""
        if self.marks is None or not any(mark in text for mark in self.special):
            return b"".join(map(self.words.__getitem__, self.split(text)))
        parts = []
        for part in self.marks.split(text):
            if part in self.special:
                parts.append(np.array([self.special[part]], "<u4").tobytes())
            else:
                parts.extend(map(self.words.__getitem__, self.split(part)))
        return b"".join(parts)

    def decode(self, ids: bytes) -> str:
        tokens = np.frombuffer(ids, "<u4").tolist()
        return b"".join(map(self.label.__getitem__, tokens)).decode("utf-8", "replace")


@cache
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def _chunks(rows: Iterator[tuple[bytes, str]], limit: int) -> Iterator[list]:
    """Results in runs of about ``limit`` bytes, so a batch of long texts stays small."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[0]) + 4 * len(row[1])
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode_decode(documents: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids (little-endian 32-bit integers, binary) and decoded (text) of every row.

    A null text counts as empty: no ids, an empty text. Rows are handled one by one, so repeated
    rows repeat and a null doc_id stays null. Other columns are ignored; an empty table gives an
    empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer)
        for batch in batches:
            encoded = (bpe.encode(text.as_py() or "") for text in batch.column("text"))
            at = 0
            for rows in _chunks(((ids, bpe.decode(ids)) for ids in encoded), 8 << 20):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, len(rows)),
                        pa.array([ids for ids, _ in rows], pa.binary()),
                        pa.array([text for _, text in rows], pa.string()),
                    ],
                    ["doc_id", "ids", "decoded"],
                )
                at += len(rows)

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, ids binary, decoded string")
