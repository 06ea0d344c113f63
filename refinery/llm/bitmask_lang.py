"""Language identification with bit-sliced Bloom filters of byte n-grams.

One table of masks answers for all languages at once: a language is a bit, an n-gram sets its
bit at ``HASHES`` places, and the AND of the masks at these places gives every language whose
filter holds the n-gram. A document's per-language counts of such bits, corrected for what a
filter of that fill reports by chance, decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from refinery.llm.stored import stored
from refinery.llm.textbatch import blocks, salted, slices

UNKNOWN = "und"
ORDERS = (3, 5)
SLOTS = 1 << 19
HASHES = 3
#: At most so many labelled documents of each language are learned from: those with the least
#: hashes in each of so many parts.
PER_LANGUAGE, PARTS = 2048, 64
#: An n-gram counts for a language if this share of its documents has it, and at least this part
#: of the share it has in the language that uses it most.
LEAST_SHARE, LEAST_PART = 0.005, 0.2
#: An n-gram has to occur in two documents where a language has at least so many to learn from.
ENOUGH = 20
#: More languages than this are an error: the masks, 4 MB for 64 of them, go to every task.
MOST_LANGUAGES = 1024


def plain_letters(column: pa.Array) -> pa.Array:
    """Lower-cased letters, every run of anything else one space, a space at both ends."""
    lowered = pc.utf8_lower(column.fill_null("").cast(pa.large_string()))
    spaced = pc.replace_substring_regex(lowered, r"\P{L}+", " ")
    return pc.binary_join_element_wise(
        pa.scalar("", pa.large_string()), pc.utf8_trim(spaced, " "), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
    )


def ngrams(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of each row as integers, and each row's offsets into them."""
    sizes = np.maximum(np.diff(offsets) - order + 1, 0)
    n = max(len(data) - order + 1, 0)
    packed = np.full(n, order, np.uint64)
    for i in range(order):
        packed = (packed << np.uint64(8)) | data[i : i + n]
    inside = np.ones(n + 1, np.int64)
    inside[n] = 0
    for end in range(1, order):  # windows that reach over the end of a row
        places = offsets[1:] - end
        inside[places[(places >= 0) & (places < n)]] = 0
    rows = np.concatenate(([0], np.cumsum(sizes)))
    return packed[inside[:n].astype(bool)], rows


def _row_ngrams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for order in ORDERS:
        yield ngrams(data, offsets, order)


def places(grams: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """(HASHES, n) table positions of n-grams."""
    return np.stack([(salted(grams, i) % np.uint64(slots)).astype(np.int64) for i in range(HASHES)])


@dataclass
class LanguageFilters:
    languages: list[str]
    masks: np.ndarray  # (words of 64 languages, slots)
    common: int = 0  # the language with the most learned documents

    def chance(self) -> np.ndarray:
        """Per language, the probability that an n-gram it never saw seems to be in its filter."""
        fill = [((self.masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(self.languages))]
        return np.array(fill) ** HASHES

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per row the number of n-grams, and per row and language how many seem to be in its filter."""
        rows, total = len(offsets) - 1, np.zeros(len(offsets) - 1)
        hits = np.zeros((rows, len(self.languages)))
        for grams, at in _row_ngrams(data, offsets):
            total += np.diff(at)
            spots = places(grams)
            for word, table in enumerate(self.masks):
                found = table[spots[0]]
                for other in spots[1:]:
                    found &= table[other]
                for i in range(64 * word, min(64 * word + 64, len(self.languages))):
                    bits = ((found >> np.uint64(i % 64)) & np.uint64(1)).astype(np.int64)
                    sums = np.concatenate(([0], np.cumsum(bits)))
                    hits[:, i] += sums[at[1:]] - sums[at[:-1]]
        return total, hits

    def shares(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Per row and language, the corrected share of n-grams in the language's filter."""
        return self._corrected(*self.hits(data, offsets))

    def _corrected(self, total: np.ndarray, hits: np.ndarray) -> np.ndarray:
        chance = self.chance()
        expected = total[:, None] * chance
        return np.clip((hits - expected) / (1 - chance) / np.maximum(total, 1)[:, None], 0, 1)

    def judge(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each row of :func:`plain_letters`."""
        rows = len(offsets) - 1
        if not self.languages:
            return [UNKNOWN] * rows, np.zeros(rows)
        total, hits = self.hits(data, offsets)
        shares = self._corrected(total, hits)
        best, score = shares.argmax(axis=1), shares.max(axis=1)
        # No language above chance: the most hits as they are, or else the most common language.
        best = np.where(score > 0, best, np.where(hits.max(axis=1) > 0, hits.argmax(axis=1), self.common))
        # A text without a letter is two spaces, which no n-gram fits in.
        lettered = np.diff(offsets) > 2
        return [self.languages[i] if x else UNKNOWN for i, x in zip(best, lettered)], np.where(lettered, score, 0.0)


def fit(documents: DataFrame, learn_from: Column) -> LanguageFilters:
    """Filters learned from the text and lang of the rows that ``learn_from`` holds for.

    Rows with a null text or lang teach nothing; a null doc_id is an id like others. Rows that repeat
    doc_id, lang and text are one document, so they take one place of the sample. The sample is at most
    ``PER_LANGUAGE`` documents of each language, stored in the shared folder; more than
    ``MOST_LANGUAGES`` different values of lang are refused.
    """
    rows = documents.filter(learn_from & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select(F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("doc_id", "text").alias("hash"))
    # A language may hold most rows: its parts are ranked apart from each other.
    order = Window.partitionBy("lang", F.pmod("hash", F.lit(PARTS))).orderBy("hash")
    ranked = rows.select("lang", "hash").distinct().select("lang", "hash", F.row_number().over(order).alias("place"))
    chosen = stored(ranked.filter(F.col("place") <= PER_LANGUAGE // PARTS).select("lang", "hash"), "chosen")
    sizes = chosen.groupBy("lang").agg(F.count(F.lit(1)).alias("documents"))
    learned = {row.lang: row.documents for row in sizes.limit(MOST_LANGUAGES + 1).collect()}
    if len(learned) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")
    # At most PER_LANGUAGE rows of 16 bytes and a name for each of them, so no text is shuffled.
    taken = rows.join(F.broadcast(chosen), ["lang", "hash"], "left_semi").groupBy("lang", "hash").agg(F.first("text").alias("text"))
    sample = stored(taken, "languages")
    languages = sorted(learned)
    masks = np.zeros(((len(languages) + 63) // 64, SLOTS), np.uint64)
    if not languages:
        return LanguageFilters([], masks)
    numbers = {name: i for i, name in enumerate(languages)}
    spots = kept_ngrams(sample, sizes).mapInArrow(_spots(numbers), "word int, place bigint, mask bigint")
    spots = stored(spots.groupBy("word", "place").agg(F.bit_or("mask").alias("mask")), "masks")
    for word in range(len(masks)):
        # At most one row per table position: the size of the filters, whatever the input.
        table = spots.where(F.col("word") == word).select("place", "mask").toArrow()
        masks[word, np.asarray(table["place"])] = np.asarray(table["mask"]).view(np.uint64)
    return LanguageFilters(languages, masks, max(range(len(languages)), key=lambda i: learned[languages[i]]))


def kept_ngrams(sample: DataFrame, sizes: DataFrame) -> DataFrame:
    """(lang, gram) of the n-grams that speak for a language."""
    counted = sample.select("lang", "text").mapInArrow(_counts, "lang string, gram bigint, n bigint")
    counted = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    share = F.col("n") / F.col("documents")
    shares = counted.join(sizes, "lang").select("lang", "gram", share.alias("share"), "n", "documents")
    most = shares.groupBy("gram").agg(F.max("share").alias("most"))
    enough = ((F.col("n") >= 2) | (F.col("documents") < ENOUGH)) & (F.col("share") >= LEAST_SHARE)
    return shares.join(most, "gram").filter(enough & (F.col("share") >= LEAST_PART * F.col("most"))).select("lang", "gram")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(language, n-gram, rows that hold it), summed within each block of a language."""
    for batch in (part for whole in batches for part in slices(whole, "text")):
        for language in pc.unique(batch.column("lang")):
            texts = batch.column("text").filter(pc.equal(batch.column("lang"), language))
            for _, data, offsets in blocks(plain_letters(texts)):
                grams = np.concatenate(
                    [np.unique(g[a:b]) for g, at in _row_ngrams(data, offsets) for a, b in zip(at[:-1], at[1:])]
                )
                grams, n = np.unique(grams, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language.as_py()] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n, pa.int64())],
                    ["lang", "gram", "n"],
                )


def _spots(numbers: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = np.array([numbers[x] for x in batch.column("lang").to_pylist()], np.int64)
            grams = np.asarray(batch.column("gram")).view(np.uint64)
            spots = places(grams).reshape(-1)
            mask = np.tile(np.uint64(1) << (number % 64).astype(np.uint64), HASHES)
            word = np.tile(number // 64, HASHES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(word.astype(np.int32)), pa.array(spots), pa.array(mask.view(np.int64))], ["word", "place", "mask"]
            )

    return run


def predict(documents: DataFrame, filters: LanguageFilters) -> DataFrame:
    """All columns of ``documents`` and lang_pred, score.

    lang_pred is ``und`` and score 0 if the text is null or has no letter, or if no language was
    learned. A text whose counts are no higher than chance has the score 0, and the language with the
    most hits before correction, or else the one with the most learned documents. Ties go to the
    language first in the alphabet. A text of any length is read whole. Columns that already have
    these names are replaced; others pass through, whatever their names.
    """
    shared = documents.sparkSession.sparkContext.broadcast(filters)
    documents = documents.drop("lang_pred", "score")
    names = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in (part for whole in batches for part in slices(whole, "text")):
            for row, data, offsets in blocks(plain_letters(batch.column("text"))):
                found, score = model.judge(data, offsets)
                part = batch.slice(row, len(found))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found, pa.string()), pa.array(score)], [*names, "lang_pred", "score"]
                )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return documents.mapInArrow(run, f"{kinds}, lang_pred string, score double")


def identify(documents: DataFrame, learn_from: Column) -> DataFrame:
    """:func:`predict` for all rows, with filters learned from those ``learn_from`` holds for.

    Needs doc_id, text and lang. Rows with null lang or text teach nothing. An empty table gives
    an empty result; repeated rows are judged alike.
    """
    return predict(documents, fit(documents, learn_from))
