"""Document quality learned from preference pairs (Bradley-Terry).

A good document is preferred to a bad one with probability sigmoid(s(good) - s(bad)), where s is
linear in features of the text. Pairs of labelled documents give the differences of features, and
the weights minimize the logistic loss of these differences. The scores of the labelled documents
are then cut at one of their quantiles, the one that separates the labels best, and the final score
maps that cut to ``CUT``.

All labelled documents are learned from. Their features are a stored table, dealt out into blocks
in which the pairs are formed; each Newton step sums the slopes of all blocks, and medians and
quantiles are read from the values in order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from refinery.llm.stored import stored
from refinery.llm.textbatch import blocks, span_hashes, words

CUT = 0.3
#: Pairs formed for each labelled document of the larger class, and at least so many for the others.
PAIRS = 8
#: Documents of the larger class in a block, and of the other one at least, if there are so many.
BLOCK, FEWEST = 4000, 500
QUANTILES = 200
RIDGE = 1e-3
FEATURES = (
    "log_words", "word_length", "long_words", "symbols", "bars", "exclamations", "capitals", "letters",
    "digits", "stops", "commas", "other_bytes", "lines", "stutters", "repeated_words", "repeated_windows",
)

_CLASSES = {
    "symbols": b"#*$%&<>^~=_@{}[]\\/+",
    "bars": b"|",
    "exclamations": b"!?",
    "capitals": bytes(range(65, 91)),
    "letters": bytes(range(97, 123)),
    "digits": bytes(range(48, 58)),
    "stops": b".",
    "commas": b",;:",
    "other_bytes": bytes(range(128, 256)),
}
WINDOW = 8
#: The columns that :func:`measured` adds.
MEASURES, TEXT_HASH = "_measures", "_text_hash"


def _sums(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[at[1:]] - total[at[:-1]]


def _repeats(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Which keys occur earlier in their row."""
    order = np.lexsort((keys, rows))
    again = np.zeros(len(keys), bool)
    again[order[1:]] = (keys[order[1:]] == keys[order[:-1]]) & (rows[order[1:]] == rows[order[:-1]])
    return again


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of :data:`FEATURES` for each text; an empty text has zeros."""
    starts, ends, at = words(data, offsets)
    n = np.diff(at)
    per_word = 1 / np.maximum(n, 1)
    sizes = ends - starts
    size = _sums(sizes, at)
    per_byte = 1 / np.maximum(size, 1)
    out = {"log_words": np.log1p(n), "word_length": size * per_word}
    out["long_words"] = _sums(sizes > 15, at) * per_word
    for name, members in _CLASSES.items():
        table = np.zeros(256, bool)
        table[list(members)] = True
        out[name] = _sums(table[data], offsets) * per_byte
    out["lines"] = _sums(data == 10, offsets) * per_word
    keys = span_hashes(data, starts, ends, fold=False)
    rows = np.repeat(np.arange(len(n)), n)
    same = np.zeros(len(keys), bool)
    same[1:] = (keys[1:] == keys[:-1]) & (rows[1:] == rows[:-1])
    out["stutters"] = _sums(same, at) * per_word
    out["repeated_words"] = _sums(_repeats(keys, rows), at) * per_word
    count = max(len(keys) - WINDOW + 1, 0)
    windows, inside = np.zeros(count, np.uint64), np.zeros(len(keys), bool)
    if count:
        with np.errstate(over="ignore"):
            for i in range(WINDOW):
                windows = windows * np.uint64(0x9E3779B97F4A7C15) + keys[i : i + count]
        whole = rows[WINDOW - 1 :] == rows[:count]
        inside[:count][whole] = _repeats(windows[whole], rows[:count][whole])
    out["repeated_windows"] = _sums(inside, at) * per_word
    return np.stack([out[name].astype(float) for name in FEATURES], axis=1)


def _expanded(x: np.ndarray, middle: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Standardized features, limited to a few widths, and their absolute values: too much can be
    as bad as too little."""
    z = np.clip((x - middle) / width, -6, 6)
    return np.concatenate((z, np.abs(z)), axis=1)


@dataclass
class Ranking:
    middle: np.ndarray
    width: np.ndarray
    weights: np.ndarray
    cut: float
    spread: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        # Summed row by row, so equal features have equal scores wherever they stand.
        return (_expanded(x, self.middle, self.width) * self.weights).sum(axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1, rising with the raw score, ``CUT`` at the chosen quantile."""
        logit = np.log(CUT / (1 - CUT)) + (self.raw(x) - self.cut) / self.spread
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def _differences(won: np.ndarray, lost: np.ndarray) -> np.ndarray:
    """Preferred less rejected: each row of the longer table meets ``PAIRS`` of the other, and both
    are walked round and round in an order that is drawn."""
    pairs = np.arange(PAIRS * max(len(won), len(lost)))
    draw = np.random.default_rng(7)
    left, right = draw.permutation(len(won)), draw.permutation(len(lost))
    turned = pairs + pairs // max(len(won), len(lost))
    of_won, of_lost = (pairs, turned) if len(won) >= len(lost) else (turned, pairs)
    return won[left[of_won % len(left)]] - lost[right[of_lost % len(right)]]


def _ordered(x: np.ndarray) -> np.ndarray:
    return x[np.lexsort(x.T)]


def _slopes(won: np.ndarray, lost: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Number of pairs, and their sums of the loss's gradient and curvature."""
    difference = _differences(won, lost)
    p = 1 / (1 + np.exp(np.clip(difference @ weights, -30, 30)))  # of losing
    curve = (difference * (p * (1 - p))[:, None]).T @ difference
    return np.concatenate(([len(p)], -difference.T @ p, curve.reshape(-1)))


def _minimized(slopes: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Weights of the least loss by Newton steps; ``slopes`` sums :func:`_slopes` over all pairs."""
    size = 2 * len(FEATURES)
    weights = np.zeros(size)
    for _ in range(30):
        found = slopes(weights)
        n, gradient, curve = found[0], found[1 : size + 1], found[size + 1 :].reshape(size, size)
        step = np.linalg.solve(curve / n + RIDGE * np.eye(size), gradient / n + RIDGE * weights)
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _quantile_ranks(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the quantiles among ``n`` values in order: the whole ranks and the rest."""
    at = np.arange(1, QUANTILES) / QUANTILES * (n - 1)
    return at.astype(np.int64), at % 1


def _best_quantile(placed: pd.DataFrame, won: int, lost: int) -> float:
    """The quantile of the scores that separates the classes best.

    ``placed`` has scores in order with their counts and those before them. Of all scores it needs
    those that hold a quantile's rank or the next one.
    """
    values = placed["value"].to_numpy(float)
    won_before, lost_before = placed["won_before"].to_numpy(np.int64), placed["lost_before"].to_numpy(np.int64)
    after = won_before + lost_before + placed["won"].to_numpy(np.int64) + placed["lost"].to_numpy(np.int64)
    ranks, rest = _quantile_ranks(won + lost)
    low = values[np.searchsorted(after, ranks, "right")]
    high = values[np.searchsorted(after, ranks + (rest > 0), "right")]
    tried = np.unique(np.minimum(low + (high - low) * rest, high))
    kept = np.searchsorted(values, tried)  # the least score kept
    balance = (won - won_before[kept]) / won + lost_before[kept] / lost
    return float(tried[balance.argmax()])


def _halfway(tried: float, below: float | None) -> float:
    """Halfway to the next score below: the quantile itself stays on the good side."""
    return tried if below is None else (tried + below) / 2


def _one_class() -> Ranking:
    """Nothing is rejected."""
    size = len(FEATURES)
    return Ranking(np.zeros(size), np.ones(size), np.zeros(2 * size), -1.0, 1.0)


def learn(x: np.ndarray, good: np.ndarray) -> Ranking:
    """What :func:`fit` learns, from features in memory as one block."""
    won, lost = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(won) or not len(lost):
        return _one_class()
    width = x.std(axis=0)
    ranking = Ranking(np.median(x, axis=0), np.where(width > 0, width, 1.0), np.empty(0), 0.0, 1.0)
    z = _expanded(x, ranking.middle, ranking.width)
    ranking.weights = _minimized(lambda weights: _slopes(z[won], z[lost], weights))
    raw = ranking.raw(x)
    counts = pd.DataFrame({"value": raw, "won": good.astype(int), "lost": (~good).astype(int)})
    counts = counts.groupby("value", as_index=False).sum()
    for name in ("won", "lost"):
        counts[f"{name}_before"] = counts[name].cumsum() - counts[name]
    tried = _best_quantile(counts, len(won), len(lost))
    ranking.cut = _halfway(tried, raw[raw < tried].max(initial=-np.inf) if (raw < tried).any() else None)
    ranking.spread = max(float(raw.std()), 1e-9)
    return ranking


def _lists(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.reshape(-1)))


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def measured(documents: DataFrame) -> DataFrame:
    """All columns of ``documents`` with the features and the hash of their texts.

    Both :func:`fit` and :func:`score` take such a table as well, with or without the texts: stored
    once, the texts need not be read twice.
    """
    documents = documents.withColumn(TEXT_HASH, F.xxhash64("text"))
    names = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in blocks(batch.column("text")):
                x = features(data, offsets)
                part = batch.slice(row, len(x))
                yield pa.RecordBatch.from_arrays([*part.columns, _lists(x)], [*names, MEASURES])

    return documents.mapInArrow(run, f"{_columns(documents)}, {MEASURES} array<double>")


def _summed(rows: DataFrame, sums: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """``sums`` of all batches of ``rows`` added up; each task sends one row to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            found = sums(batch)
            total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([_lists(total[None, :])], ["sums"])

    return np.sum([row.sums for row in rows.mapInArrow(run, "sums array<double>").collect()], axis=0)


def _placed(counted: DataFrame, *order: str) -> DataFrame:
    """``counted`` with ``won_before`` and ``lost_before``: the sums of ``won`` and ``lost`` over all rows
    before, in the total order of ``order``. Ranges of rows are summed one by one."""
    rows = stored(counted.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ordered")
    ranges = rows.groupBy("part").agg(F.sum("won").alias("won"), F.sum("lost").alias("lost"))

    def before(name: str, window) -> Column:
        return F.coalesce(F.sum(name).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    # One row for each range.
    ranges = ranges.select("part", *[before(n, Window.orderBy("part")).alias(f"{n}_first") for n in ("won", "lost")])
    inside = Window.partitionBy("part").orderBy(*order)
    rows = rows.select("*", *[before(n, inside).alias(f"{n}_inside") for n in ("won", "lost")])
    sums = [(F.col(f"{n}_first") + F.col(f"{n}_inside")).alias(f"{n}_before") for n in ("won", "lost")]
    return rows.join(F.broadcast(ranges), "part").select(*counted.columns, *sums)


def _holding(placed: DataFrame, ranks: np.ndarray) -> pd.DataFrame:
    """The rows of ``placed`` that hold one of the ``ranks``, in order; at most one for each rank."""
    ranks = np.unique(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            won, lost, won_before, lost_before = (
                batch.column(n).to_numpy() for n in ("won", "lost", "won_before", "lost_before")
            )
            first = won_before + lost_before
            held = np.searchsorted(ranks, first) < np.searchsorted(ranks, first + won + lost)
            yield batch.filter(pa.array(held))

    found = placed.mapInArrow(run, _columns(placed)).toPandas()
    return found.iloc[np.argsort((found["won_before"] + found["lost_before"]).to_numpy())]


def _classes() -> dict[str, Column]:
    return {"won": F.col("good").cast("long"), "lost": (~F.col("good")).cast("long")}


def _counted(rows: DataFrame, *names: str) -> DataFrame:
    return rows.groupBy(*names).agg(*[F.sum(one).alias(name) for name, one in _classes().items()])


def _medians(taught: DataFrame, n: int) -> np.ndarray:
    """Of each feature, from its values in order: feature f has the ranks from f * n on."""
    values = taught.select("good", F.posexplode("measures").alias("feature", "value"))
    first = np.arange(len(FEATURES)) * n
    wanted = first + (n - 1) // 2, first + n // 2
    held = _holding(_placed(_counted(values, "feature", "value"), "feature", "value"), np.concatenate(wanted))
    after = (held["won_before"] + held["lost_before"] + held["won"] + held["lost"]).to_numpy()
    low, high = (held["value"].to_numpy()[np.searchsorted(after, ranks, "right")] for ranks in wanted)
    return (low + high) / 2


def _dealt(taught: DataFrame, won: int, lost: int) -> DataFrame:
    """Blocks of the features of both classes, each document in one of them.

    The documents of a class are numbered by the hash of their id and each block has a run of the
    numbers. A class too small for ``FEWEST`` documents in every block is walked round and round.
    """
    n_blocks = -(-max(won, lost) // BLOCK)
    rows = _placed(taught.withColumns({"key": F.xxhash64("doc_id"), **_classes()}), "key", "doc_id")

    def of_class(won_value, lost_value) -> Column:
        return F.when(F.col("good"), won_value).otherwise(lost_value)

    places = [max(n, n_blocks * min(n, FEWEST)) for n in (won, lost)]
    rows = rows.withColumn("places", of_class(*map(F.lit, places)).cast("long"))
    rank, step = of_class(F.col("won_before"), F.col("lost_before")), of_class(F.lit(won), F.lit(lost)).cast("long")
    rows = rows.withColumn("place", F.explode(F.sequence(rank, F.col("places") - 1, step)))
    rows = rows.withColumn("block", F.expr(f"place * {n_blocks}L div places"))

    members = [F.flatten(F.collect_list(F.when(which, F.col("measures")))) for which in (F.col("good"), ~F.col("good"))]
    found = rows.groupBy("block").agg(members[0].alias("won"), members[1].alias("lost"))
    # In order, so that the sums come out the same each time.
    return stored(found.sortWithinPartitions("block").select("won", "lost"), "blocks")


def _weights(dealt: DataFrame, middle: np.ndarray, width: np.ndarray) -> np.ndarray:
    def slopes(weights: np.ndarray) -> np.ndarray:
        def sums(batch: pa.RecordBatch) -> np.ndarray:
            total = np.zeros(1 + len(weights) + len(weights) ** 2)
            for row in range(batch.num_rows):
                won, lost = (
                    _expanded(_ordered(_matrix(batch.column(name).slice(row, 1))), middle, width)
                    for name in ("won", "lost")
                )
                total += _slopes(won, lost, weights)
            return total

        return _summed(dealt, sums)

    return _minimized(slopes)


def _deviation(rows: DataFrame, values: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """Standard deviation of the columns of ``values``, which are best given from about the middle on."""

    def sums(batch: pa.RecordBatch) -> np.ndarray:
        x = values(batch)
        return np.concatenate(([len(x)], x.sum(axis=0), (x * x).sum(axis=0)))

    found = _summed(rows, sums)
    n, (total, squares) = found[0], found[1:].reshape(2, -1)
    return np.sqrt(np.maximum(squares / n - (total / n) ** 2, 0))


def fit(documents: DataFrame, labels: DataFrame, learn_from: Column) -> Ranking:
    """A ranking learned from all labelled documents for which ``learn_from`` (on doc_id) holds.

    A document with several labels counts as good only if all are 1; labels without a document are
    not used. Of rows that repeat a doc_id the one whose text has the least hash is taken. The
    driver gets sums, at most 400 scores and 32 feature values.
    """
    if MEASURES not in documents.columns:
        documents = measured(documents.select("doc_id", "text"))
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & learn_from)
    known = known.groupBy("doc_id").agg((F.min("quality") >= 1).alias("good"))
    rows = documents.select("doc_id", F.struct(TEXT_HASH, F.col(MEASURES).alias("measures")).alias("found"))
    rows = rows.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("found").alias("found"))
    rows = rows.join(known, "doc_id").select("doc_id", "good", "found.measures")
    taught = stored(rows.sortWithinPartitions("doc_id"), "taught")
    # ``sum`` of no rows is null.
    won, lost = (int(n or 0) for n in _counted(taught).first())
    if not won or not lost:
        return _one_class()

    middle = _medians(taught, won + lost)
    width = _deviation(taught, lambda batch: _matrix(batch.column("measures")) - middle)
    ranking = Ranking(middle, np.where(width > 0, width, 1.0), np.empty(0), 0.0, 1.0)
    ranking.weights = _weights(_dealt(taught, won, lost), ranking.middle, ranking.width)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = ranking.raw(_matrix(batch.column("measures")))
            yield pa.RecordBatch.from_arrays([batch.column("good"), pa.array(values)], ["good", "value"])

    scores = taught.select("good", "measures").mapInArrow(raw, "good boolean, value double")
    placed = _placed(_counted(scores, "value"), "value")
    ranks, _ = _quantile_ranks(won + lost)
    tried = _best_quantile(_holding(placed, np.concatenate((ranks, ranks + 1))), won, lost)
    cut = _halfway(tried, placed.filter(F.col("value") < tried).agg(F.max("value")).first()[0])
    spread = _deviation(taught, lambda batch: ranking.raw(_matrix(batch.column("measures")))[:, None] - cut)
    ranking.cut, ranking.spread = cut, max(float(spread[0]), 1e-9)
    return ranking


def score(documents: DataFrame, ranking: Ranking) -> DataFrame:
    """All columns of ``documents`` with score (0 to 1) and predicted (1 from ``CUT`` on, else 0).

    Null texts are scored as empty ones. Columns that have these names are replaced; repeated
    rows score alike, and an empty table gives an empty result. The columns of a :func:`measured`
    table are used and dropped.
    """
    documents = documents.drop("score", "predicted")
    known = MEASURES in documents.columns
    result = documents.drop(MEASURES, TEXT_HASH) if known else documents
    names = result.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if known:
                found = ranking.scores(_matrix(batch.column(MEASURES)))
                yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(found)], [*names, "score"])
                continue
            for row, data, offsets in blocks(batch.column("text")):
                found = ranking.scores(features(data, offsets))
                part = batch.slice(row, len(found))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found)], [*names, "score"])

    scored = documents.mapInArrow(run, f"{_columns(result)}, score double")
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
