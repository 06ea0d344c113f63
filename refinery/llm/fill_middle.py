"""Fill-in-middle transformation: cuts found through a Fenwick tree over fixed text blocks.

A text is cut into units, runs of ASCII letters or any other single code point. Its bytes lie in
blocks of ``BLOCK`` bytes; two Fenwick trees hold how many units and how many code points start in
each block. A cut after k units is found by binary lifting over the trees, which ends at the block
the next unit starts in, and then among the unit starts of that block alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from refinery.llm.textbatch import blocks

BLOCK = 4096
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 documents so many stay plain; of 100 others so many have the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MADE = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes begin a unit, and which a code point, of the texts at ``offsets``."""
    letter = _LETTER[data]
    characters = (data & 0xC0) != 0x80
    units = characters.copy()
    units[1:] &= ~(letter[1:] & letter[:-1])
    units[offsets[:-1][np.diff(offsets) > 0]] = True
    return units, characters


def fenwick(counts: np.ndarray) -> np.ndarray:
    """The tree whose node i (from 1) holds the sum of the last ``i & -i`` counts up to i."""
    sums = np.concatenate(([0], np.cumsum(counts)))
    nodes = np.arange(len(sums))
    return sums - sums[nodes - (nodes & -nodes)]


class CutFinder:
    """Byte place and code points of the cut after any number of units of one text."""

    def __init__(self, units: np.ndarray, characters: np.ndarray):
        self.units, self.characters = units, characters
        firsts = np.arange(0, len(units), BLOCK)
        self.unit_tree = fenwick(np.add.reduceat(units, firsts, dtype=np.int64)) if len(units) else np.zeros(1, np.int64)
        self.char_tree = fenwick(np.add.reduceat(characters, firsts, dtype=np.int64)) if len(units) else np.zeros(1, np.int64)

    def cut(self, k: int) -> tuple[int, int]:
        blocks_in_all = len(self.unit_tree) - 1
        block, left, chars = 0, k, 0
        step = 1 << blocks_in_all.bit_length() >> 1
        while step:
            after = block + step
            if after <= blocks_in_all and self.unit_tree[after] <= left:
                block = after
                left -= int(self.unit_tree[after])
                chars += int(self.char_tree[after])
            step >>= 1
        first = min(block * BLOCK, len(self.units))
        if block == blocks_in_all:
            return len(self.units), chars
        place = int(np.flatnonzero(self.units[first : first + BLOCK])[left])
        return first + place, chars + int(np.count_nonzero(self.characters[first : first + place]))


def draws(seed: int, doc_id: int | None) -> list[int]:
    """The first four 32-bit numbers of the SHA-256 of seed and id; a null id counts as empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4]) for i in range(0, 16, 4)]


def transform(text: bytes, units: np.ndarray, characters: np.ndarray, drawn: list[int], plain: int, suffix_first: int) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    n = int(np.count_nonzero(units))
    marks = [mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE)]
    if not text or any(mark in text for mark in marks) or drawn[2] % 100 >= 100 - plain:
        return n, "plain", None, None, text
    finder = CutFinder(units, characters)
    first, second = sorted(draw % (n + 1) for draw in drawn[:2])
    (a, a_chars), (b, b_chars) = finder.cut(first), finder.cut(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if drawn[3] % 100 < suffix_first:
        form, parts = "spm", (marks[1], suffix, marks[0], prefix, marks[2], middle)
    else:
        form, parts = "psm", (marks[0], prefix, marks[1], suffix, marks[2], middle)
    return n, form, a_chars, b_chars - a_chars, b"".join(parts)


def _made(rows: list[tuple]) -> list[pa.Array]:
    n, form, prefix, middle, output = zip(*rows)
    return [
        pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
        pa.array(output, pa.binary()).cast(pa.string()),
    ]


def fill_in_middle(
    documents: DataFrame, *, seed: int = 1, plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output of every row's whole text.

    ``documents`` has doc_id and text; other columns, whatever their names, are ignored. The draws
    depend on seed and doc_id alone, so repeated rows have equal outputs, and rows with a null
    doc_id share the draws of an empty id. A null text counts as empty; an empty text and one that
    contains a mark stay plain. A text of any length is read whole: it needs two flags a byte, and
    blocks of 1 MB of shorter texts are flagged at a time. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for row, data, offsets in blocks(batch.column("text")):
                units, characters = starts(data, offsets)
                whole = data.tobytes()
                made = []
                for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                    drawn = draws(seed, ids[row + i].as_py())
                    made.append(transform(whole[a:b], units[a:b], characters[a:b], drawn, plain, suffix_first))
                yield pa.RecordBatch.from_arrays([ids.slice(row, len(made)), *_made(made)], ["doc_id", *_NAMES])

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id bigint, {_MADE}")


_NAMES = [part.split()[0] for part in _MADE.split(", ")]


def restored(output: Column, form: Column) -> Column:
    """The text that an output of the given form was made from.

    No part contains a mark, and no mark starts inside the end of a part, so the first occurrence
    of each mark after the one before is the mark itself.
    """
    psm = F.regexp_replace(output, f"(?s)^{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*)", "$1$3$2")
    spm = F.regexp_replace(output, f"(?s)^{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*)", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
