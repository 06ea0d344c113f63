"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with a cosine of at least t lie within epsilon = sqrt(2 - 2 t) of each other, and so
do their projections. All vectors are projected on the leading principal dimensions and sorted by
label and by the grid cells of width epsilon in these dimensions, one dimension after the other.
Tiles are intervals of this order. The join recurses over pairs of intervals and skips every pair
whose boxes are farther apart than epsilon: between tasks by joins of box tables, from the whole
sequence down to pairs of tiles, and within a pair of tiles by halving, until short ones are left
whose vectors are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from refinery.llm.components import components
from refinery.llm.stored import stored

COSINE = 0.98
#: Principal dimensions that the grid uses.
DIMENSIONS = 8
#: Vectors of a tile, and of an interval that is compared without halving.
TILE, LEAF = 2048, 256
#: A tile's number is its task and its place there; an interval of tasks has 2^4 parts.
TASK_BITS, FAN_BITS = 32, 4
#: Boxes are drawn a little wider than rounding can matter.
SLACK = 1e-6


def _prepared(vectors: DataFrame) -> DataFrame:
    """vec_id, label, embedding in double precision, and two keys of label and vector.

    The keys are null for rows that cannot link. Together they have 128 bits.
    """
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    usable = F.coalesce(F.col("label").isNotNull() & fine & some, F.lit(False))
    rows = vectors.select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
    keys = {"key": F.xxhash64("label", "embedding"), "other_key": F.xxhash64(F.lit(1), "embedding", "label")}
    return rows.withColumns({name: F.when(usable, key) for name, key in keys.items()})


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as unit vectors."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = values.reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_length(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.asarray(batch.column("size"))
    for size in np.unique(sizes):
        yield batch.filter(pa.array(sizes == size))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length of vectors: count, sum and sum of outer products of a task's rows."""
    sums: dict[int, list] = {}
    for batch in batches:
        for part in _by_length(batch):
            x = _matrix(part.column("embedding"))
            held = sums.setdefault(x.shape[1], [0, 0.0, 0.0])
            held[0] += len(x)
            held[1] = held[1] + x.sum(axis=0)
            held[2] = held[2] + x.T @ x
    if sums:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(sums), pa.int32()),
                pa.array([n for n, _, _ in sums.values()], pa.int64()),
                pa.array([m.tolist() for _, m, _ in sums.values()], pa.list_(pa.float64())),
                pa.array([s.reshape(-1).tolist() for _, _, s in sums.values()], pa.list_(pa.float64())),
            ],
            ["size", "n", "total", "products"],
        )


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each length of vectors, the leading directions of their spread (any fixed ones are right).

    Each task adds up its rows; what reaches the driver per length are sums of the size of one
    vector squared, whatever the number of rows.
    """
    sums = vectors.select("size", "embedding").mapInArrow(
        _moments, "size int, n bigint, total array<double>, products array<double>"
    )
    parts = sums.select("size", "n", F.posexplode(F.concat("total", "products")).alias("at", "value"))
    whole = parts.groupBy("size", "at").agg(F.sum("n").alias("n"), F.sum("value").alias("value"))
    axes = {}
    rows = whole.groupBy("size").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", "value"))).alias("all"))
    for row in rows.collect():
        values = np.array([x["value"] for x in row["all"]])
        mean = values[: row["size"]] / row["n"]
        spread = values[row["size"] :].reshape(row["size"], row["size"]) / row["n"] - np.outer(mean, mean)
        _, directions = np.linalg.eigh(spread)
        axes[row["size"]] = np.ascontiguousarray(directions[:, ::-1][:, :DIMENSIONS])
    return axes


def _gridded(axes: dict[int, np.ndarray], epsilon: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _by_length(batch):
                x = _matrix(part.column("embedding"))
                cells = np.zeros((len(x), DIMENSIONS), np.int32)
                near = np.floor(x @ axes[x.shape[1]] / epsilon).astype(np.int32)
                cells[:, : near.shape[1]] = near
                ends = np.arange(0, cells.size + 1, DIMENSIONS, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.ListArray.from_arrays(ends, pa.array(cells.reshape(-1)))],
                    [*part.schema.names, "cells"],
                )

    return run


def _tiles(axes: dict[int, np.ndarray], tile: int):
    """Intervals of a sorted partition, none across labels or lengths, as one row each."""

    def packed(rows: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        x = np.concatenate([_matrix(chunk) for chunk in table["embedding"].chunks])
        near = x @ axes[x.shape[1]]
        low, high = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
        low[: near.shape[1]], high[: near.shape[1]] = near.min(axis=0), near.max(axis=0)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([TaskContext.get().partitionId() << TASK_BITS | number], pa.int64()),
                pa.array(table["label"].slice(0, 1).to_pylist(), table["label"].type),
                pa.array([x.shape[1]], pa.int32()),
                pa.array([low.tolist()], pa.list_(pa.float64())),
                pa.array([high.tolist()], pa.list_(pa.float64())),
                pa.array([np.asarray(table["node"]).astype(np.int64).tobytes()], pa.binary()),
                pa.array([np.asarray(table["copies"]).astype(np.int64).tobytes()], pa.binary()),
                pa.array([x.tobytes()], pa.binary()),
            ],
            ["tile", "label", "size", "low", "high", "nodes", "copies", "vectors"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, key, number = [], 0, None, 0
        for batch in batches:
            keys = list(zip(batch.column("label").to_pylist(), batch.column("size").to_pylist()))
            at = 0
            while at < len(keys):
                if keys[at] != key or count == tile:
                    if held:
                        yield packed(held, number)
                        number += 1
                    held, count, key = [], 0, keys[at]
                end = at
                while end < len(keys) and keys[end] == key and count + end - at < tile:
                    end += 1
                held.append(batch.slice(at, end - at))
                count += end - at
                at = end
        if held:
            yield packed(held, number)

    return run


class _TileJoin:
    """Links between two sorted runs of unit vectors, by halving."""

    def __init__(self, x, copies_x, y, copies_y, axes, cosine: float, same: bool):
        self.x, self.y, self.same, self.cosine = x, y, same, cosine
        self.px, self.py = x @ axes, y @ axes
        self.epsilon = np.sqrt(max(2 - 2 * cosine, 0.0)) + SLACK
        self.copies_x, self.copies_y = copies_x, copies_y
        self.links_x, self.links_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
        # Nodes of x come first, those of y after them; of a tile with itself they are the same.
        self.root = np.arange(len(x) if same else len(x) + len(y))

    def roots(self, nodes: np.ndarray) -> np.ndarray:
        found = self.root[nodes]
        while (self.root[found] != found).any():
            found = self.root[found]
        self.root[nodes] = found
        return found

    def _unite(self, one: list[int], two: list[int]) -> None:
        root = self.root
        for i, j in zip(one, two):
            while root[i] != i:
                i = root[i]
            while root[j] != j:
                j = root[j]
            root[max(i, j)] = min(i, j)

    def _apart(self, a: int, b: int, c: int, d: int) -> bool:
        px, py = self.px[a:b], self.py[c:d]
        gap = np.maximum(px.min(axis=0) - py.max(axis=0), py.min(axis=0) - px.max(axis=0))
        gap = np.maximum(gap, 0)
        return bool((gap * gap).sum() > self.epsilon * self.epsilon)

    def run(self, a: int, b: int, c: int, d: int) -> None:
        if a >= b or c >= d or (self.same and d <= a) or self._apart(a, b, c, d):
            return
        if b - a <= LEAF and d - c <= LEAF:
            self._compare(a, b, c, d)
        elif self.same and (a, b) == (c, d):
            m = (a + b) // 2
            self.run(a, m, a, m)
            self.run(a, m, m, b)
            self.run(m, b, m, b)
        elif b - a >= d - c:
            m = (a + b) // 2
            self.run(a, m, c, d)
            self.run(m, b, c, d)
        else:
            m = (c + d) // 2
            self.run(a, b, c, m)
            self.run(a, b, m, d)

    def _compare(self, a: int, b: int, c: int, d: int) -> None:
        linked = self.x[a:b] @ self.y[c:d].T >= self.cosine
        if self.same and (a, b) == (c, d):
            np.fill_diagonal(linked, False)
            linked_y = None
        else:
            linked_y = linked
        if not linked.any():
            return
        self.links_x[a:b] += linked @ self.copies_y[c:d]
        if linked_y is not None:
            target = self.links_x if self.same else self.links_y
            target[c:d] += self.copies_x[a:b] @ linked_y
        shift = 0 if self.same else len(self.x)
        rows, columns = np.arange(a, b), np.arange(c, d) + shift
        while True:  # each row joins one partner of another component, until there is none
            left, right = self.roots(rows), self.roots(columns)
            apart = linked & (left[:, None] != right[None, :])
            some = np.flatnonzero(apart.any(axis=1))
            if not len(some):
                break
            self._unite(left[some].tolist(), right[apart[some].argmax(axis=1)].tolist())


def _joined(axes: dict[int, np.ndarray], cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda name, kind: np.frombuffer(batch.column(name)[i].as_buffer(), kind)
                size = batch.column("size")[i].as_py()
                same = batch.column("a")[i].as_py() == batch.column("b")[i].as_py()
                x, y = get("vectors_a", np.float64).reshape(-1, size), get("vectors_b", np.float64).reshape(-1, size)
                join = _TileJoin(x, get("copies_a", np.int64), y, get("copies_b", np.int64), axes[size], cosine, same)
                join.run(0, len(x), 0, len(y))
                nodes = get("nodes_a", np.int64) if same else np.concatenate((get("nodes_a", np.int64), get("nodes_b", np.int64)))
                links = join.links_x if same else np.concatenate((join.links_x, join.links_y))
                some = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[some]), pa.array(links[some]), pa.array(nodes[join.roots(some)])],
                    ["node", "links", "root"],
                )

    return run


def near_tiles(boxes: DataFrame, epsilon: float) -> DataFrame:
    """Pairs (a, b), a <= b, of tiles of one label and length whose boxes come within ``epsilon``.

    Tiles are numbered in grid order. So intervals of the sequence, 2^FAN_BITS to the power of k tasks'
    tiles each, have boxes of their own, and only the parts of two near intervals are compared: from
    the whole sequence down to single tiles, joined by label, length and interval.
    """
    last = boxes.agg(F.max("tile")).first()[0] or 0
    depth = -(-(last >> TASK_BITS).bit_length() // FAN_BITS)
    shifts = [0, *[TASK_BITS + FAN_BITS * k for k in range(depth + 1)]]
    pairs = boxes.select("label", "size", F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b")).distinct()
    for above, shift in reversed(list(zip(shifts[1:], shifts))):
        node, parent = (F.shiftright("tile", by).alias(name) for by, name in ((shift, "node"), (above, "parent")))
        ends = [
            F.array(*[end(F.col(name)[i]) for i in range(DIMENSIONS)]).alias(name) for end, name in ((F.min, "low"), (F.max, "high"))
        ]
        inside = boxes.groupBy("label", "size", node, parent).agg(*ends) if shift else boxes.select("label", "size", node, parent, "low", "high")
        sides = {x: inside.select("label", "size", *[F.col(c).alias(f"{c}_{x}") for c in ("node", "parent", "low", "high")]) for x in "ab"}
        for x, side in sides.items():
            pairs = pairs.join(side.withColumnRenamed(f"parent_{x}", x), ["label", "size", x])
        gaps = [
            F.greatest(F.col("low_a")[i] - F.col("high_b")[i], F.col("low_b")[i] - F.col("high_a")[i], F.lit(0.0)) for i in range(DIMENSIONS)
        ]
        near = sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]) <= (epsilon + SLACK) ** 2
        pairs = pairs.where((F.col("node_a") <= F.col("node_b")) & near)
        pairs = pairs.select("label", "size", F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    return pairs.select("a", "b")


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links, component_id, kept.

    Rows are linked if their labels are equal, their vectors have the same length, and the
    cosine in double precision is at least ``cosine``. A null label, and a vector that is
    null, empty, zero or holds null, NaN or infinite numbers, links with nothing. A repeated row is
    another vector. component_id is the least vec_id reachable, kept whether it is the row's own.
    Rows with a null vec_id link as others do, count for others, and are not kept; a group of
    only such rows has a null component. Other columns are ignored.

    Equal rows of a label are first joined into one node with a count, so a very common vector
    is compared once.
    """
    rows = _prepared(vectors)
    nodes = rows.filter("key IS NOT NULL").groupBy("key", "other_key", "label", "embedding").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least")
    )
    # Numbers are given once: what is stored keeps them.
    nodes = nodes.withColumns({"node": F.monotonically_increasing_id(), "size": F.size("embedding")})
    nodes = stored(nodes, "nodes")
    axes = principal_axes(nodes)
    epsilon = float(np.sqrt(max(2 - 2 * cosine, 0.0))) or 1.0

    compared = nodes.select("node", "label", "size", "copies", "embedding")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in compared.schema)
    gridded = compared.mapInArrow(_gridded(axes, epsilon), f"{kinds}, cells array<int>")
    gridded = gridded.withColumns({f"c{i}": F.col("cells")[i] for i in range(DIMENSIONS)}).drop("cells")
    order = ["label", "size", *[f"c{i}" for i in range(DIMENSIONS)], "node"]
    ranges = max(1, -(-nodes.count() // (4 * TILE)))
    sorted_rows = gridded.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    label_kind = dict(nodes.dtypes)["label"]
    tiles = sorted_rows.select("label", "size", "node", "copies", "embedding").mapInArrow(
        _tiles(axes, TILE),
        f"tile bigint, label {label_kind}, size int, low array<double>, high array<double>, nodes binary, copies binary, vectors binary",
    )
    tiles = stored(tiles, "tiles")

    pairs = near_tiles(tiles.select("tile", "label", "size", "low", "high"), epsilon)
    pairs = stored(pairs, "tile-pairs")
    sides = {
        s: tiles.select(F.col("tile").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("nodes", "copies", "vectors")]) for s in "ab"
    }
    work = pairs.join(sides["a"], "a").join(sides["b"], "b").join(tiles.select(F.col("tile").alias("a"), "size"), "a")
    found = stored(work.mapInArrow(_joined(axes, cosine), "node bigint, links bigint, root bigint"), "tile-links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    placed = components(found.select("node", "root"))
    labelled = nodes.select("node", "key", "other_key", "copies", "least").join(placed, "node", "left")
    labelled = stored(labelled.withColumn("component", F.coalesce("component", "node")), "placed-nodes")
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    results = labelled.join(least, "component").join(links, "node", "left").select(
        "key", "other_key", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    out = rows.select("vec_id", "key", "other_key").join(stored(results, "node-results"), ["key", "other_key"], "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.cast("bigint").alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
