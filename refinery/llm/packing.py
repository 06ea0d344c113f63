"""Packing token pieces into sequences of fixed capacity by swap-based local search.

Texts become token ids, ids become pieces of at most the capacity, and pieces are dealt out evenly
into groups that one task can hold. Each group starts from best-fit decreasing. Then bins are
emptied: the emptiest bin moves a piece to a fuller bin, exchanges one for a smaller one, or one
for two smaller ones, whenever this raises the sum of squared fills, until it is empty or stuck.
Bins of all groups that are not full are then dealt out anew and searched on from where they stand,
with other bins as partners, until that frees no more.
"""

from __future__ import annotations

import functools
import itertools
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from refinery.llm.bpe_automaton import byte_letters
from refinery.llm.stored import stored
from refinery.llm.textbatch import blocks, span_hashes, words

CAPACITY = 2048
#: Pieces that one task packs at a time.
GROUP = 20_000
#: Bins are dealt out anew while that frees one in so many; a search among them ends after so many
#: bins in a row that could not be emptied.
WORTH, PATIENCE = 200, 128
#: Pieces whose ids a worker remembers before it starts anew.
REMEMBERED = 1_000_000
END_OF_TEXT = 0
_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


# --- token ids --------------------------------------------------------------------------

_SPACE, _LETTER, _DIGIT, _OTHER = range(4)


def _byte_classes() -> np.ndarray:
    kinds = np.full(256, _OTHER, np.int8)
    kinds[[0x20, *range(0x09, 0x0E)]] = _SPACE
    kinds[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
    kinds[48:58] = _DIGIT
    return kinds


_CLASSES = _byte_classes()


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the pieces a tokenizer looks at one by one, and which it has to cut itself.

    Runs of letters, single digits, and runs of anything else but white space. A word that holds an
    apostrophe before a letter, or a character between U+0080 and U+024F that is no letter or
    does not keep its length in lower case, is one piece to be cut by the tokenizer.
    """
    kind = _CLASSES[data]
    first = np.zeros(len(data), bool)
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    change = np.ones(len(data), bool)
    change[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT) | first[1:]
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], len(data))
    whole = kind[starts] != _SPACE
    starts, ends = starts[whole], ends[whole]

    after = np.append(data[1:], np.uint8(0))
    odd = (data == 0xC2) | (data == 0xC3) & ((after == 0x97) | (after == 0xB7)) | (data == 0xC4) & (after == 0xB0)
    odd |= (data == 0x27) & (_CLASSES[after] == _LETTER)
    odd = np.flatnonzero(odd)
    if not len(odd):
        return starts, ends, np.zeros(len(starts), bool)
    word_starts, word_ends, _ = words(data, offsets)
    number = np.unique(np.searchsorted(word_starts, odd, "right") - 1)
    word = np.searchsorted(word_starts, starts, "right") - 1
    plain = ~np.isin(word, number)
    starts = np.concatenate((starts[plain], word_starts[number]))
    ends = np.concatenate((ends[plain], word_ends[number]))
    uncut = np.concatenate((np.zeros(plain.sum(), bool), np.ones(len(number), bool)))
    order = np.argsort(starts, kind="stable")
    return starts[order], ends[order], uncut[order]


class WordIds:
    """Ids of texts, piece by piece: the tokenizer is asked once for each new piece.

    This holds for tokenizers that fold case, drop white space, and cut texts where
    :func:`units` does. Texts with characters beyond Latin Extended-B, whose lower case or
    composition could depend on their neighbours, go to the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.letters = {byte: letter for letter, byte in byte_letters().items()}
        self._forget()

    def _forget(self) -> None:
        self.known, self.begins = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.counts, self.ids, self.used = np.empty(0, np.int64), np.empty(1 << 16, np.uint32), 0

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _piece(self, piece: bytes) -> list[int]:
        lowered = piece.lower() if piece.isascii() else piece.decode().lower().encode()
        return [t.id for t in self.tokenizer.model.tokenize(lowered.decode("latin-1").translate(self.letters))]

    def _learn(self, hashes: np.ndarray, pieces: list[bytes], uncut: list[bool]) -> None:
        found = [[] if whole else self._piece(piece) for piece, whole in zip(pieces, uncut)]
        for i in np.flatnonzero(uncut).tolist():
            found[i] = self._encode([pieces[i].decode()])[0]
        counts = np.array([len(ids) for ids in found], np.int64)
        flat = np.array([i for ids in found for i in ids], np.uint32)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.empty(len(self.ids), np.uint32)))
        self.ids[self.used : self.used + len(flat)] = flat
        at = np.searchsorted(self.known, hashes)
        self.begins = np.insert(self.begins, at, self.used + np.cumsum(counts) - counts)
        self.counts = np.insert(self.counts, at, counts)
        self.known = np.insert(self.known, at, hashes)
        self.used += len(flat)

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.known, hashes)
        inside = np.minimum(at, max(len(self.known) - 1, 0))
        return at, (self.known[inside] == hashes) if len(self.known) else np.zeros(len(hashes), bool)

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows, and each row's offsets into them."""
        starts, ends, uncut = units(data, offsets)
        if len(self.known) > REMEMBERED:
            self._forget()
        hashes, first, inverse = np.unique(
            span_hashes(data, starts, ends, fold=True), return_index=True, return_inverse=True
        )
        place, known = self._places(hashes)
        if not known.all():
            new = first[~known]
            raw = data.tobytes()
            pieces = [raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())]
            self._learn(hashes[~known], pieces, uncut[new].tolist())
            place, _ = self._places(hashes)
        begins, sizes = self.begins[place][inverse], self.counts[place][inverse]
        total = np.concatenate(([0], np.cumsum(sizes)))
        at = np.repeat(begins - total[:-1], sizes) + np.arange(total[-1])
        return self.ids[at], total[np.searchsorted(starts, offsets)]

    def rows(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(row, ids) of every row; null is empty."""
        special = [token.content.encode() for token in self.tokenizer.get_added_tokens_decoder().values()]
        for first, data, offsets in blocks(column):
            # Lead bytes from 0xC9 on belong to characters from U+0240 on.
            far = np.flatnonzero(data >= 0xC9)
            whole = set((np.searchsorted(offsets, far, "right") - 1).tolist())
            raw = data.tobytes()
            if any(mark in raw for mark in special):
                texts = (raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()))
                whole |= {i for i, text in enumerate(texts) if any(mark in text for mark in special)}
            ids, at = self.block(data, offsets)
            for i in range(len(offsets) - 1):
                if i in whole:
                    yield first + i, np.array(self._encode([raw[offsets[i] : offsets[i + 1]].decode()])[0], np.uint32)
                else:
                    yield first + i, ids[at[i] : at[i + 1]]


@cache
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def _cut(tokenizer: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _word_ids(tokenizer)
        for batch in batches:
            rows, pieces, starts, lengths, checks = [], [], [], [], []
            for row, ids in encoder.rows(batch.column("text")):
                ids = np.append(ids, np.uint32(END_OF_TEXT)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(start)
                    lengths.append(len(part))
                    checks.append(zlib.crc32(part.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    pa.array(pieces, pa.int32()),
                    *[pa.array(x, pa.int64()) for x in (starts, lengths, checks)],
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def token_pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every text's ids and a final 0, cut at ``capacity``."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_cut(tokenizer, capacity), _PIECES)


# --- bins -------------------------------------------------------------------------------


def _best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    bins = np.empty(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by what is free in them
    some, count = 0, 0  # bit f is set where free[f] is not empty
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fits = some >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            chosen = free[room].pop()
            if not free[room]:
                some &= ~(1 << room)
        else:
            room, chosen, count = capacity, count, count + 1
        bins[item] = chosen
        free[room - length].append(chosen)
        some |= 1 << (room - length)
    return bins


class _Search:
    """Local search over the bins that are not full."""

    def __init__(self, lengths: np.ndarray, bins: np.ndarray, capacity: int):
        self.capacity, self.all_bins = capacity, bins
        fill = np.bincount(bins, weights=lengths).astype(np.int64)
        self.items = np.flatnonzero(fill[bins] < capacity)
        self.size = lengths[self.items].astype(np.int64)
        self.bin = bins[self.items]
        self.fill = fill
        self.members: dict[int, set[int]] = {}
        for i, b in enumerate(self.bin.tolist()):
            self.members.setdefault(b, set()).add(i)

    def run(self, least_bins: int, steps: int, patience: int | None = None) -> None:
        """Empty bins until as few are left as can hold all, nothing helps, or the steps are used.

        With ``patience`` the search ends after so many bins in a row that could not be emptied.
        """
        used, failed = len(np.unique(self.all_bins)), 0
        waiting = sorted(self.members, key=lambda b: (self.fill[b], b), reverse=True)
        while waiting and used > least_bins and steps > 0 and (patience is None or failed < patience):
            victim = waiting.pop()
            if not self.members[victim]:
                continue
            self._pairs(victim)
            while steps > 0 and self.members[victim] and self._improve(victim):
                steps -= 1
            used -= not self.members[victim]
            failed = failed + 1 if self.members[victim] else 0
        self.all_bins[self.items] = self.bin

    def _pairs(self, victim: int) -> None:
        first, second = [], []
        for b, inside in self.members.items():
            if b != victim and len(inside) > 1 and self.fill[b] < self.capacity:
                # The three smallest of a bin make its pairs: a pair has to be smaller than one item.
                low = sorted(inside, key=lambda i: (self.size[i], i))[:3]
                for x in range(len(low)):
                    for y in range(x + 1, len(low)):
                        first.append(low[x])
                        second.append(low[y])
        self.one, self.two = np.array(first, np.int64), np.array(second, np.int64)

    def _move(self, item: int, to: int) -> None:
        old, size = int(self.bin[item]), int(self.size[item])
        self.members[old].discard(item)
        self.members[to].add(item)
        self.bin[item] = to
        self.fill[old] -= size
        self.fill[to] += size

    def _improve(self, victim: int) -> bool:
        """One change that takes length out of ``victim`` into a bin at least as full."""
        room = self.capacity - self.fill[self.bin]
        usable = (self.bin != victim) & (self.fill[self.bin] >= self.fill[victim]) & (room > 0)
        one, two = self.one, self.two
        if len(one):
            together = (self.bin[one] == self.bin[two]) & usable[one]
            pair_size, pair_room = self.size[one] + self.size[two], room[one]
        for item in sorted(self.members[victim], key=lambda i: (-self.size[i], i)):
            size = self.size[item]
            moves = np.flatnonzero(usable & (room >= size))
            if len(moves):
                self._move(item, int(self.bin[moves[room[moves].argmin()]]))
                return True
            gain = size - self.size
            gain = np.where(usable & (gain > 0) & (gain <= room), gain, 0)
            best = int(gain.argmax()) if len(gain) else 0
            best_gain = int(gain[best]) if len(gain) else 0
            pair_gain, pair = 0, 0
            if len(one):
                gains = size - pair_size
                gains = np.where(together & (gains > 0) & (gains <= pair_room), gains, 0)
                pair = int(gains.argmax())
                pair_gain = int(gains[pair])
            if best_gain and best_gain >= pair_gain:
                to = int(self.bin[best])
                self._move(best, victim)
                self._move(item, to)
                return True
            if pair_gain:
                to = int(self.bin[one[pair]])
                self._move(int(one[pair]), victim)
                self._move(int(two[pair]), victim)
                self._move(item, to)
                return True
        return False


def _offsets(lengths: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Gapless offsets of the items within their bins, in the order they are given."""
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(lengths[order])
    firsts = np.concatenate(([True], np.diff(bins[order]) > 0))
    base = (ends - lengths[order])[firsts][np.cumsum(firsts) - 1]
    offsets = np.empty(len(lengths), np.int64)
    offsets[order] = ends - lengths[order] - base
    return offsets


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY, bins: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; offsets are gapless in each bin.

    Bins are numbered from 0 without gaps, or keep the numbers of a packing ``bins`` to go on from.
    """
    lengths = np.asarray(lengths, np.int64)
    if not len(lengths):
        return lengths, lengths
    if lengths.min() < 1 or lengths.max() > capacity:
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    given = None
    if bins is None:
        bins = _best_fit_decreasing(lengths, capacity)
    else:
        given, bins = np.unique(bins, return_inverse=True)
        bins = bins.reshape(-1).copy()
    least = -(-int(lengths.sum()) // capacity)
    _Search(lengths, bins, capacity).run(least, steps=4 * len(lengths), patience=None if given is None else PATIENCE)
    if given is None:
        bins = np.unique(bins, return_inverse=True)[1].reshape(-1)
        return bins, _offsets(lengths, bins)
    return given[bins], _offsets(lengths, bins)


def _pack_group(capacity: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group = list(frames)
        if group:
            # As many rows as the caller chose for one group.
            pieces = pd.concat(group, ignore_index=True)
            bins, offsets = pack_lengths(pieces["length"].to_numpy(), capacity)
            yield pieces.assign(sequence_id=bins + (TaskContext.get().partitionId() << 40), offset=offsets)

    return run


def _search_on(capacity: int):
    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = pack_lengths(pieces["length"].to_numpy(), capacity, pieces["sequence_id"].to_numpy())
        return pieces.assign(sequence_id=bins, offset=offsets).drop(columns="__group")

    return run


def _open(placed: DataFrame, capacity: int) -> tuple[DataFrame, DataFrame]:
    """Pieces of sequences that are full, and of those that are not."""
    fills = placed.groupBy("sequence_id").agg(F.sum("length").alias("__fill"))
    filled = placed.join(fills, "sequence_id")
    full = F.col("__fill") >= capacity
    return tuple(filled.where(side).select(*placed.columns) for side in (full, ~full))


def _left(pieces: DataFrame) -> tuple[int, int, int]:
    """Sequences, pieces and tokens."""
    by_sequence = pieces.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), F.count(F.lit(1)).alias("n"))
    row = by_sequence.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    return int(row[0]), int(row[1]), int(row[2])


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``pieces`` with sequence_id and offset; ``length`` must lie between 1 and ``capacity``.

    Rows are dealt out evenly, whatever they hold, so no key can make a group large. With several
    groups, the sequences that are not full are then dealt out by a hash of their number, another
    one each time, and searched on. Full ones are left. This ends when a round frees fewer than one
    in ``WORTH`` of them, or when as few are left as can hold the tokens. Columns called sequence_id, offset, __group or
    __fill are replaced.
    """
    pieces = pieces.drop("sequence_id", "offset", "__group", "__fill")
    groups = max(1, -(-pieces.count() // group))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id bigint, offset bigint"
    placed = pieces.repartition(groups).mapInPandas(_pack_group(capacity), kinds)
    if groups == 1:
        return placed
    done: list[DataFrame] = []
    waiting, freed = stored(placed, "packed"), None
    for turn in itertools.count():
        full, some = _open(waiting, capacity)
        done.append(full)
        some = stored(some, "open")
        sequences, n, tokens = _left(some)
        if sequences <= -(-tokens // capacity) or (freed is not None and WORTH * freed < sequences):
            break
        deal = F.pmod(F.xxhash64("sequence_id", F.lit(turn)), F.lit(max(1, -(-n // group))))
        waiting = stored(some.withColumn("__group", deal).groupBy("__group").applyInPandas(_search_on(capacity), kinds), "packed")
        freed = sequences - waiting.select("sequence_id").distinct().count()
    return functools.reduce(DataFrame.unionByName, done, some)


def pack_documents(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the single id 0. Repeated rows are packed each for itself, a null
    doc_id stays null. Only texts longer than the capacity are cut. Columns other than doc_id and
    text are ignored; an empty table gives an empty result.
    """
    return pack(stored(token_pieces(documents, tokenizer, capacity), "pieces"), capacity)
