"""Benchmark decontamination by an FM-index per training shard.

A shard is a run of documents with about ``SHARD_WORDS`` words, or one longer document. Its words
are numbered by their 64-bit hashes, its suffixes sorted, and the words before the sorted suffixes
(the Burrows-Wheeler transform) kept in a wavelet matrix: one bit vector with rank counts per bit
of the word numbers. Backward search narrows the rows of a phrase from its last word to its first,
for all phrases of a benchmark at once; the rows left are its occurrences. Every ``SAMPLED``-th
place of a document is stored with its row, the first one always, so an occurrence is located by a
few steps back to a sampled row and never leaves its document. Occurrences merge into spans.

The index is a table of one row per shard, built once and searched for any number of benchmarks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from refinery.llm.stored import stored
from refinery.llm.textbatch import blocks, mix, span_hashes, words as word_spans

SHARD_WORDS = 1 << 19
SAMPLED = 4
WINDOW = 10
#: Words of benchmark items that are searched at a time, 8 bytes each in every task.
BLOCK_WORDS = 1 << 20
#: Occurrences that are located at a time.
LOCATED = 1 << 19

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = 0x20
_FOLD[65:91] = np.arange(97, 123)

_INDEX = (
    "shard bigint, n bigint, doc_ids array<bigint>, text_keys array<binary>, doc_words binary, vocabulary binary, "
    "less binary, zeros binary, bits binary, marked binary, samples binary"
)
_FOUND = "shard bigint, row int, doc_id bigint, text_key binary, n_words bigint, starts array<int>, ends array<int>, items array<string>"


def _names(ddl: str) -> list[str]:
    return [field.split()[0] for field in ddl.split(", ")]


def hashed_words(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the folded words of a run of texts, and each text's offsets into them."""
    for _, data, offsets in blocks(column):
        data = _FOLD[data]
        starts, ends, rows = word_spans(data, offsets)
        yield span_hashes(data, starts, ends, fold=False), rows


def suffix_order(symbols: np.ndarray, distinct: int) -> np.ndarray:
    """Places of ``symbols`` (below ``distinct``) in the order of the suffixes that start there.

    Suffixes are ranked by their first symbols, as many as fit into a key; then the ranks of those
    that still tie are refined by the rank of what follows, twice as far each time. Symbols that
    end a document occur once, so no tie reaches beyond a document's end.
    """
    n = len(symbols)
    if n == 0:
        return np.empty(0, np.int64)
    place_bits = max(n - 1, 1).bit_length()
    key, known = symbols.astype(np.uint64), 1
    while distinct ** (known + 1) < 1 << (63 - place_bits):
        following = np.zeros(n, np.uint64)
        following[: max(n - known, 0)] = symbols[known:]
        key = key * np.uint64(distinct) + following
        known += 1
    order, new = _sorted(key, np.arange(n), (distinct**known).bit_length())
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    tied = ~(new & np.append(new[1:], True))
    slots = np.flatnonzero(tied)
    new = new[slots]
    while len(slots):
        places = order[slots]
        group = np.cumsum(new) - 1
        key = group.astype(np.uint64) * np.uint64(n) + rank[places + known].astype(np.uint64)
        places, fresh = _sorted(key, places, (int(group[-1] + 1) * n).bit_length())
        order[slots] = places
        rank[places] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(slots)), 0))]
        tied = ~(fresh & np.append(fresh[1:], True))
        slots, new = slots[tied], fresh[tied]
        known *= 2
    return order


def _sorted(key: np.ndarray, values: np.ndarray, key_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``values`` in the order of ``key``, and which of them begin a new key."""
    bits = max(len(key) - 1, 1).bit_length()
    if key_bits + bits <= 64:
        # One sort of numbers instead of a sort of places: key and place share 64 bits.
        packed = np.sort(key << np.uint64(bits) | np.arange(len(key), dtype=np.uint64))
        by = (packed & np.uint64((1 << bits) - 1)).astype(np.int64)
        ordered = packed >> np.uint64(bits)
    else:
        by = np.argsort(key, kind="stable")
        ordered = key[by]
    return values[by], np.append(True, ordered[1:] != ordered[:-1])


class RankedBits:
    """Rows of packed bits with the number of ones before each 64-bit word."""

    def __init__(self, words: np.ndarray):
        self.words = words
        counts = np.cumsum(np.bitwise_count(words), axis=1, dtype=np.uint32)
        self.before = np.concatenate((np.zeros((len(words), 1), np.uint32), counts[:, :-1]), axis=1)

    @staticmethod
    def pack(bits: np.ndarray) -> np.ndarray:
        """The bits of one row, 64 to a number, with room for a rank at the very end."""
        packed = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        packed[: (len(bits) + 7) // 8] = np.packbits(bits, bitorder="little")
        return packed.view(np.uint64)

    def at(self, row: int, i: np.ndarray) -> np.ndarray:
        return (self.words[row, i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0

    def ones(self, row: int, i: np.ndarray) -> np.ndarray:
        """How many of the first i bits are ones."""
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[row, i >> 6].astype(np.int64) + np.bitwise_count(self.words[row, i >> 6] & below)


def build_shard(word_hashes: np.ndarray, doc_words: np.ndarray) -> dict[str, np.ndarray]:
    """The index of one shard: documents of ``doc_words`` words each, one after the other.

    Symbol 0 stands for the end of a document; word w of the sorted vocabulary is symbol w + 1.
    """
    vocabulary, numbers = np.unique(word_hashes, return_inverse=True)
    lengths = doc_words[doc_words > 0]
    ends = np.cumsum(lengths + 1) - 1
    n = int(len(word_hashes) + len(lengths))
    is_word = np.ones(n, bool)
    is_word[ends] = False
    symbols = np.zeros(n, np.int64)
    symbols[is_word] = numbers.reshape(-1) + len(lengths)
    symbols[ends] = np.arange(len(lengths))
    order = suffix_order(symbols, len(lengths) + len(vocabulary))
    symbols[is_word] += 1 - len(lengths)
    symbols[ends] = 0
    counts = np.bincount(symbols, minlength=len(vocabulary) + 1)
    sequence = symbols[order - 1]  # before the first place stands the last end
    levels = max(len(vocabulary).bit_length(), 1)
    bits, zeros = [], []
    for level in reversed(range(levels)):
        ones = (sequence >> level & 1).astype(bool)
        bits.append(RankedBits.pack(ones))
        sequence = np.concatenate((sequence[~ones], sequence[ones]))
        zeros.append(np.count_nonzero(~ones))
    inside = np.arange(n) - np.repeat(ends - lengths, lengths + 1)
    sampled = (inside % SAMPLED == 0) & is_word
    marked = sampled[order]
    return {
        "vocabulary": vocabulary, "less": (np.cumsum(counts) - counts).astype(np.int32), "zeros": np.array(zeros, np.int64),
        "bits": np.stack(bits), "marked": RankedBits.pack(marked), "samples": order[marked].astype(np.int32),
    }


class Shard:
    """Search in the index of one shard."""

    def __init__(self, n: int, doc_words: np.ndarray, vocabulary, less, zeros, bits, marked, samples):
        self.n, self.vocabulary, self.zeros, self.samples = n, vocabulary, zeros, samples
        self.levels = RankedBits(bits.reshape(len(zeros), -1))
        self.marked = RankedBits(marked.reshape(1, -1))
        lengths = np.where(doc_words > 0, doc_words + 1, 0)
        self.doc_starts = np.cumsum(lengths) - lengths
        # Where a symbol's occurrences start among its own in the last level.
        symbols = np.arange(len(less))
        self.shift = less - self._down(symbols, np.zeros(len(less), np.int64))
        self.less = np.append(less, n).astype(np.int64)

    def _down(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        """The place below all levels of the i-th place, as seen by each symbol."""
        for row, zeros in enumerate(self.zeros.tolist()):
            ones = self.levels.ones(row, i)
            i = np.where(symbols >> (len(self.zeros) - 1 - row) & 1, zeros + ones, i - ones)
        return i

    def numbers(self, word_hashes: np.ndarray) -> np.ndarray:
        """Symbols of words, 0 for those the shard does not hold."""
        if not len(self.vocabulary):
            return np.zeros(len(word_hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, word_hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == word_hashes, at + 1, 0)

    def search(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases (rows of symbols, all of one length) that occur, their first and last row."""
        phrases = np.flatnonzero((symbols > 0).all(axis=1))
        last = symbols[phrases, -1]
        first, end = self.less[last], self.less[last + 1]
        for column in reversed(range(symbols.shape[1] - 1)):
            symbol = symbols[phrases, column]
            first = self.shift[symbol] + self._down(symbol, first)
            end = self.shift[symbol] + self._down(symbol, end)
            alive = first < end
            phrases, first, end = phrases[alive], first[alive], end[alive]
        return phrases, first, end

    def _back(self, rows: np.ndarray) -> np.ndarray:
        """The rows of the suffixes that start one word earlier."""
        symbols, i = np.zeros(len(rows), np.int64), rows
        for row, zeros in enumerate(self.zeros.tolist()):
            bit = self.levels.at(row, i)
            ones = self.levels.ones(row, i)
            symbols = symbols << 1 | bit
            i = np.where(bit, zeros + ones, i - ones)
        return self.shift[symbols] + i

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of ``rows`` start."""
        places = np.empty(len(rows), np.int64)
        waiting, steps = np.arange(len(rows)), 0
        while len(waiting):
            found = self.marked.at(0, rows)
            places[waiting[found]] = self.samples[self.marked.ones(0, rows[found])] + steps
            waiting, rows = waiting[~found], self._back(rows[~found])
            steps += 1
        return places


def build_index(documents: DataFrame, *, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The stored index table of all documents, one row per shard.

    ``documents`` has doc_id and text; other columns are ignored. Null texts and texts without a
    word are documents of no words; repeated rows are documents each. Texts are read whole: one
    longer than a shard is a shard by itself, and needs about 100 bytes a word while it is built.
    An empty table gives an index without shards.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, number = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        size = 0
        for batch in batches:
            row = 0
            for hashes, offsets in hashed_words(batch.column("text")):
                rows = batch.slice(row, len(offsets) - 1)
                row += len(offsets) - 1
                if size and size + len(hashes) > shard_words:
                    yield _packed(partition << 33 | number, held)
                    number, held, size = number + 1, [], 0
                held.append((hashes, np.diff(offsets), rows.column("doc_id"), rows.column("text_key")))
                size += len(hashes)
        if held:
            yield _packed(partition << 33 | number, held)

    # The key says to which texts spans belong, also where a doc_id repeats or is null.
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), text_key().alias("text_key")
    )
    return stored(rows.mapInArrow(run, _INDEX), "fm-index")


def text_key() -> Column:
    return F.unhex(F.md5(F.col("text").cast("string")))


def _packed(shard: int, held: list[tuple]) -> pa.RecordBatch:
    hashes, doc_words, ids, keys = zip(*held)
    doc_words = np.concatenate(doc_words).astype(np.int64)
    index = build_shard(np.concatenate(hashes), doc_words)
    n = int((doc_words + (doc_words > 0)).sum())
    lists = [
        pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        for values in (pa.concat_arrays(ids), pa.concat_arrays(keys))
    ]
    parts = {"doc_words": doc_words, **index}
    return pa.RecordBatch.from_arrays(
        [pa.array([shard], pa.int64()), pa.array([n], pa.int64()), *lists, *[pa.array([a.tobytes()], pa.binary()) for a in parts.values()]],
        _names(_INDEX),
    )


_KINDS = {"bits": np.uint64, "marked": np.uint64, "vocabulary": np.uint64, "less": np.int32, "samples": np.int32}


def _opened(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, Shard]:
    def part(name: str) -> np.ndarray:
        return np.frombuffer(batch.column(name)[row].as_py(), _KINDS.get(name, np.int64))

    names = ("doc_words", "vocabulary", "less", "zeros", "bits", "marked", "samples")
    doc_words, *parts = map(part, names)
    return doc_words, Shard(batch.column("n")[row].as_py(), doc_words, *parts)


class Phrases:
    """The windows of a block of items: which word hashes, and the items each window belongs to."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        sequences = [(number[name], np.frombuffer(data, np.uint64)) for name, data in items if data]
        words = np.concatenate([s for _, s in sequences]) if sequences else np.empty(0, np.uint64)
        self.vocabulary, numbered = np.unique(words, return_inverse=True)
        self.by_length: list[tuple[np.ndarray, np.ndarray]] = []
        lengths: dict[int, list] = {}
        at = 0
        for item, sequence in sequences:
            size = min(window, len(sequence))
            whole = numbered.reshape(-1)[at : at + len(sequence)]
            at += len(sequence)
            lengths.setdefault(size, []).append((np.lib.stride_tricks.sliding_window_view(whole, size), item))
        sets: list[np.ndarray] = []  # the sets of items that windows belong to, as (set, item) pairs
        first_set = 0
        for found in lengths.values():
            windows = np.concatenate([w for w, _ in found])
            owners = np.repeat([item for _, item in found], [len(w) for w, _ in found])
            windows, which = np.unique(windows, axis=0, return_inverse=True)
            pairs = np.unique(np.stack((which.reshape(-1), owners), axis=1), axis=0)
            # Windows of the same items share one set, told by the sum of the items' hashes.
            sums = np.zeros(len(windows), np.uint64)
            with np.errstate(over="ignore"):
                np.add.at(sums, pairs[:, 0], mix(pairs[:, 1].astype(np.uint64) + np.uint64(1)))
            _, example, set_of = np.unique(sums, return_index=True, return_inverse=True)
            named = np.full(len(windows), -1)
            named[example] = np.arange(len(example))
            mine = pairs[named[pairs[:, 0]] >= 0]
            sets.append(np.stack((named[mine[:, 0]] + first_set, mine[:, 1]), axis=1))
            self.by_length.append((windows, set_of.reshape(-1) + first_set))
            first_set += len(example)
        pairs = np.concatenate(sets) if sets else np.empty((0, 2), np.int64)
        pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
        self.set_items, self.set_at = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(first_set + 1))

    def items_of(self, docs: np.ndarray, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document, item) pairs from (document, set) pairs, in order."""
        sizes = self.set_at[sets + 1] - self.set_at[sets]
        at = np.repeat(self.set_at[sets] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        width = max(len(self.names), 1)
        pairs = np.unique(np.repeat(docs, sizes) * width + self.set_items[at])
        return pairs // width, pairs % width


def matches(shard: Shard, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merged spans of places that phrases cover, and the (document, item) pairs found."""
    known = shard.numbers(phrases.vocabulary)
    change = np.zeros(shard.n + 1, np.int32)
    pairs = [np.empty(0, np.int64)]
    width = max(len(phrases.set_at), 1)
    for windows, sets in phrases.by_length:
        found, first, end = shard.search(known[windows])
        sizes = end - first
        row, total = 0, np.cumsum(sizes)
        while row < len(found):
            before = total[row] - sizes[row]
            last = max(int(np.searchsorted(total, before + LOCATED, "right")), row + 1)
            part = sizes[row:last]
            rows = np.repeat(first[row:last] - (np.cumsum(part) - part), part) + np.arange(part.sum())
            places = shard.locate(rows)
            # A place starts one window of this length at most.
            change[places] += 1
            change[places + windows.shape[1]] -= 1
            docs = np.searchsorted(shard.doc_starts, places, "right") - 1
            pairs.append(np.unique(docs * width + np.repeat(sets[found[row:last]], part)))
            row = last
    covered = np.concatenate(([False], np.cumsum(change[:-1]) > 0, [False]))
    edges = np.flatnonzero(covered[1:] != covered[:-1])
    pairs = np.unique(np.concatenate(pairs))
    return edges[::2], edges[1::2], *phrases.items_of(pairs // width, pairs % width)


def _searched(phrases_of, every: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = None
        for batch in batches:
            for row in range(batch.num_rows):
                phrases = phrases or phrases_of()
                doc_words, shard = _opened(batch, row)
                starts, ends, docs, items = matches(shard, phrases)
                owner = np.searchsorted(shard.doc_starts, starts, "right") - 1
                rows = np.arange(len(doc_words)) if every else np.unique(owner)
                span_at = np.searchsorted(owner, np.append(rows, len(doc_words)))
                item_at = np.searchsorted(docs, np.append(rows, len(doc_words)))
                if not len(rows):
                    continue
                base = shard.doc_starts[owner]
                lists = [
                    pa.ListArray.from_arrays(pa.array(span_at, pa.int32()), pa.array(places - base, pa.int32()))
                    for places in (starts, ends)
                ]
                names = pa.array(phrases.names, pa.string()).take(pa.array(items))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(rows), batch.column("shard")[row].as_py())),
                        pa.array(rows, pa.int32()),
                        batch.column("doc_ids")[row].values.take(pa.array(rows)),
                        batch.column("text_keys")[row].values.take(pa.array(rows)),
                        pa.array(doc_words[rows]),
                        *lists,
                        pa.ListArray.from_arrays(pa.array(item_at, pa.int32()), names),
                    ],
                    _names(_FOUND),
                )

    return run


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, row = batch.column("item_id"), 0
        for hashes, offsets in hashed_words(batch.column("text")):
            data = [hashes[a:b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [names.slice(row, len(data)), pa.array(data, pa.binary())], ["item_id", "words"]
            )
            row += len(data)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping and touching spans of a row, found by several searches, as one."""
    for batch in batches:
        starts, ends = [], []
        for a, b in zip(batch.column("starts"), batch.column("ends")):
            a, b = (np.asarray(x.values, np.int64) for x in (a, b))
            by = np.argsort(a, kind="stable")
            a, reach = a[by], np.maximum.accumulate(b[by])
            fresh = np.append(True, a[1:] > reach[:-1])[: len(a)]
            starts.append(a[fresh])
            ends.append(reach[np.append(fresh[1:], True)[: len(a)]])
        for name, values in (("starts", starts), ("ends", ends)):
            column = batch.schema.get_field_index(name)
            batch = batch.set_column(column, name, pa.array(values, pa.list_(pa.int32())))
        yield batch


def find_phrases(
    index: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """Per document row of the index: doc_id, text_key, n_words, spans and items.

    ``starts`` and ``ends`` are the merged spans of words [start, end) that windows of items cover;
    ``items`` lists the items with a window in the document, in order. ``benchmark`` has item_id and
    text. A window is ``window`` consecutive words of an item, or the whole of one with fewer; items
    without a word have none. A null item_id counts as empty; rows of one item_id are one item.

    The items are searched in blocks of about ``block_words`` words, so the driver and a task hold
    one block at a time, however large the benchmark is (one item is never split). Each block runs
    over the whole stored index. Documents without a window are rows with empty lists.
    """
    named = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    texts = benchmark.select(named.alias("item_id"), F.col("text").cast("string").alias("text"))
    items = stored(texts.mapInArrow(_item_words, "item_id string, words binary"), "benchmark")
    total = items.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()[0] // 8
    n_blocks = max(-(-total // block_words), 1)
    parts = []
    for block in range(n_blocks):
        chosen = items.where(F.pmod(F.hash("item_id"), F.lit(n_blocks)) == block).where(F.octet_length("words") > 0)
        held = [(row.item_id, bytes(row.words)) for row in chosen.toLocalIterator()]
        phrases_of = _phrases_later(held, window)
        found = index.mapInArrow(_searched(phrases_of, every=block == 0), _FOUND)
        parts.append(found if n_blocks == 1 else stored(found, "phrases"))
    if n_blocks == 1:
        return parts[0]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    lists = [F.flatten(F.collect_list(name)).alias(name) for name in ("starts", "ends")]
    one = together.groupBy("shard", "row").agg(
        *[F.first(name).alias(name) for name in ("doc_id", "text_key", "n_words")],
        *lists, F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return one.mapInArrow(_merged, _FOUND)


def _phrases_later(items: list[tuple[str, bytes]], window: int):
    return lambda: Phrases(items, window)


def covered_words() -> Column:
    """How many words the spans of a row of :func:`find_phrases` cover."""
    return F.aggregate(F.arrays_zip("starts", "ends"), F.lit(0).cast("bigint"), lambda n, s: n + s["ends"] - s["starts"])


def without_spans(documents: DataFrame, found: DataFrame) -> DataFrame:
    """``documents`` with the spans of :func:`find_phrases` cut out of their texts.

    A span is cut from the start of its first word to the end of its last one. Spans belong to
    texts, so rows that share a text, or a null doc_id, are all cut; null texts stay null. The
    documents' columns keep their names, types and order.
    """
    spans = found.where(F.size("starts") > 0).groupBy(F.col("text_key").alias("__key")).agg(
        F.first("starts").alias("__starts"), F.first("ends").alias("__ends")
    )
    # Null texts are spread by keys that no span has.
    number = F.concat(F.lit("no text "), F.monotonically_increasing_id().cast("string"))
    joined = documents.withColumn("__key", F.coalesce(text_key(), number.cast("binary"))).join(spans, "__key", "left").drop("__key")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields)
    return joined.mapInArrow(_cut, kinds)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        spans = zip(batch.column("text"), batch.column("__starts"), batch.column("__ends"))
        for text, first, last in spans:
            whole = text.as_py()
            if whole is not None and first.is_valid:
                raw = whole.encode()
                data = _FOLD[np.frombuffer(raw, np.uint8)]
                starts, ends, _ = word_spans(data, np.array([0, len(data)]))
                kept, at = [], 0
                for a, b in zip(first.as_py(), last.as_py()):
                    kept.append(raw[at : starts[a]])
                    at = ends[b - 1]
                whole = b"".join([*kept, raw[at:]]).decode()
            texts.append(whole)
        place = batch.schema.get_field_index("text")
        batch = batch.set_column(place, "text", pa.array(texts, pa.string()))
        yield batch.select([name for name in batch.schema.names if name not in ("__starts", "__ends")])
