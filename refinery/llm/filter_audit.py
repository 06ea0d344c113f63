"""Filter interaction audit: what each filter removes, in every order, from one Gray-code walk.

Each document fails some of the k filters; documents with the same failures form a mask cell. The
subsets of filters are walked in Gray-code order, one filter switched on or off at a time. Every
cell counts how many active filters it fails: it leaves the survivors when that count leaves zero
and returns when it is zero again. The survivors of all 2^k subsets are stored, and every step of
every order is the difference of two of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

FILTERS = "ABCDE"
_SPACES = " \t\n\x0b\x0c\r"
#: Counted documents, those labelled good, those labelled toxic.
WEIGHTS = ("n", "good", "toxic")
_STEPS = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
    "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
)


def walk(masks: np.ndarray, weights: np.ndarray, filters: int) -> np.ndarray:
    """Weights of the survivors of every subset of filters; row s belongs to the subset with bits s."""
    states = np.empty((1 << filters, weights.shape[1]), np.int64)
    failures = np.zeros(len(masks), np.int64)
    running, active = weights.sum(axis=0), 0
    states[0] = running
    for number in range(1, 1 << filters):
        toggled = number & -number
        cells = (masks & toggled) != 0
        active ^= toggled
        if active & toggled:
            running = running - weights[cells & (failures == 0)].sum(axis=0)
            failures[cells] += 1
        else:
            failures[cells] -= 1
            running = running + weights[cells & (failures == 0)].sum(axis=0)
        states[active] = running
    return states


def steps(states: np.ndarray, filters: Sequence[str]) -> Iterator[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of all orders."""
    k, every = len(filters), (1 << len(filters)) - 1
    shapley = [0] * k
    for f in range(k):
        for subset in range(1 << k):
            if not subset >> f & 1:
                size = subset.bit_count()
                orders = factorial(size) * factorial(k - 1 - size)
                shapley[f] += orders * int(states[subset, 0] - states[subset | 1 << f, 0])
    for order in permutations(range(k)):
        name, before = "".join(filters[f] for f in order), 0
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            removed, good, toxic = (int(x) for x in states[before] - states[after])
            failing = int(states[0, 0] - states[1 << f, 0])
            unique = int(states[every ^ 1 << f, 0] - states[every, 0])
            yield name, step, int(states[after, 0]), removed, failing - removed, unique, good, toxic, shapley[f]
            before = after


def audit(cells: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step.

    ``cells`` has part, mask (bit i: fails filter i), n, good and toxic. A part's group holds at
    most one row per mask after the sums, whatever the number of documents; equal cells are added
    up. A null part counts as empty. No cells give no rows. There are k! orders, so few filters.
    """
    k = len(filters)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        states = walk(rows["mask"].to_numpy(), rows[list(WEIGHTS)].to_numpy(np.int64), k)
        found = pd.DataFrame(list(steps(states, filters)), columns=[f.split()[0] for f in _STEPS.split(", ")[1:]])
        found.insert(0, "part", key[0])
        return found

    summed = cells.groupBy(F.coalesce("part", F.lit("")).alias("part"), "mask").agg(
        *[F.sum(name).cast("bigint").alias(name) for name in WEIGHTS]
    )
    return summed.groupBy("part").applyInPandas(run, _STEPS)


def _measured(read: DataFrame) -> DataFrame:
    """Words, distinct words, and the conditions of the filters that look at characters, beside each text."""
    text = F.col("text")
    trimmed = F.btrim(text, F.lit(_SPACES))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    split = read.select(
        "doc_id", "part", F.unhex(F.sha2(text, 256)).alias("digest"), F.split(trimmed, f"[{_SPACES}]+").alias("split"),
        (trimmed == "").alias("blank"), (100 * capitals > 3 * F.length(text)).alias("shouting"),
        text.rlike("[#$%&*|]").alias("symbols"),
    )
    words = F.when(F.col("blank"), 0).otherwise(F.size("split"))
    return split.withColumns({"words": words, "distinct": F.size(F.array_distinct("split"))}).drop("split", "blank")


def _bit(condition: Column, filter_name: str) -> Column:
    return F.when(condition, 1 << FILTERS.index(filter_name)).otherwise(0)


def mask_cells(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by language and failure mask: part, mask, n, good, toxic.

    A: under 200 words. B: fewer than half of the words distinct. C: more than 3 percent capitals.
    D: holds one of ``#$%&*|``. E: a smaller doc_id has the identical text.

    ``documents`` has doc_id, text and lang, ``labels`` doc_id, quality and toxic; other columns are
    ignored. A null text counts as empty, a null lang as the empty part. A null doc_id is neither
    smaller than another nor labelled. Rows that repeat a doc_id count each; with one text, none of
    them is smaller. A document is good, or toxic, if any of its labels says so. Texts of any length
    are read whole, once; what is shuffled is a digest and some numbers a row. Rows with one text
    are counted before they meet, so a text that a third of all rows share is a few rows a task.
    """
    named = [F.coalesce(F.col(a).cast("string"), F.lit("")).alias(b) for a, b in (("lang", "part"), ("text", "text"))]
    read = _measured(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), *named))
    own = (
        _bit(F.col("words") < 200, "A") + _bit(100 * F.col("distinct") < 50 * F.col("words"), "B")
        + _bit(F.col("shouting"), "C") + _bit(F.col("symbols"), "D")
    )
    rows = read.groupBy("doc_id", "part", "digest", own.alias("own")).agg(F.count(F.lit(1)).alias("n"))
    said = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    # Rows with a null id are spread by their digest; no label has such a key.
    by = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null "), F.hex("digest")))
    said = said.where("good OR toxic").select(F.col("doc_id").cast("string").alias("by"), "good", "toxic")
    labelled = rows.withColumn("by", by).join(said, "by", "left")
    flags = [F.coalesce(name, F.lit(False)).alias(name) for name in ("good", "toxic")]
    known = F.col("doc_id").isNotNull()
    per_text = labelled.groupBy("digest", "part", "own", *flags).agg(
        F.sum("n").alias("n"),
        F.min(F.when(known, F.struct("doc_id", "n"))).alias("first"),
        F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("unnamed"),
    )
    # One row per text, part and label by now, not one per document.
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    leads = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = per_text.withColumn("least", least).select("part", "own", "good", "toxic", "n", (leads + F.col("unnamed")).alias("first_n"))
    copy_bit = 1 << FILTERS.index("E")
    both = F.array(
        F.struct(F.col("own").alias("mask"), F.col("first_n").alias("n")),
        F.struct((F.col("own") + copy_bit).alias("mask"), (F.col("n") - F.col("first_n")).alias("n")),
    )
    cells = split.select("part", "good", "toxic", F.inline(both)).where("n > 0")
    return cells.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.when(F.col(name), F.col("n")).otherwise(0)).alias(name) for name in ("good", "toxic")],
    )
