"""Connected components of a graph of links, by large-star and small-star rounds on Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from refinery.llm.stored import stored


#: Edges that one task holds at a time.
CHUNK = 100_000


def _sized(df: DataFrame, rows: int) -> DataFrame:
    """No more tasks than ``rows`` need; a table with more rows than that keeps its partitions."""
    return df.coalesce(max(1, -(-rows // CHUNK)))


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a chunk as stars: every node with the least node that the chunk links it to."""
    held: list[np.ndarray] = []
    for batch in batches:
        held.append(np.stack([np.asarray(batch.column(c)) for c in ("u", "v")]))
        if sum(part.shape[1] for part in held) >= CHUNK:
            yield _least_links(np.concatenate(held, axis=1))
            held = []
    if held:
        yield _least_links(np.concatenate(held, axis=1))


def _least_links(edges: np.ndarray) -> pa.RecordBatch:
    nodes, index = np.unique(edges, return_inverse=True)
    index = index.reshape(2, -1)
    root = list(range(len(nodes)))
    for i, j in zip(index[0].tolist(), index[1].tolist()):
        while root[i] != i:
            root[i] = i = root[root[i]]
        while root[j] != j:
            root[j] = j = root[root[j]]
        if i < j:
            root[j] = i
        else:
            root[i] = j
    for i in range(len(root)):  # a node's root is never larger than the node
        root[i] = root[root[i]]
    least = nodes[root]
    moved = least < nodes
    return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(least[moved])], ["u", "v"])


def _stars(edges: DataFrame, rows: int) -> DataFrame:
    return stored(_sized(edges, rows).mapInArrow(_forest, "u bigint, v bigint"), "stars")


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one least node, which has none itself."""
    ends = edges.select(F.col("u").alias("node"), "v").union(
        edges.select(F.col("v").alias("node"), F.lit(None).cast("bigint").alias("v"))
    )
    seen = ends.groupBy("node").agg(
        F.min("v").alias("least"), F.max("v").alias("most"), F.count_if(F.col("v").isNull()).alias("below")
    )
    return seen.filter("least <> most OR (least IS NOT NULL AND below > 0)").count() == 0


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    # Every edge leads from a larger to a smaller node here.
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (two bigint columns), component the least node.

    Loops and nulls are ignored. First the edges of each chunk become stars. Then, in each round, a
    node's neighbours move to its least neighbour, until all nodes of a component point at its
    least one. Each round is written to the shared folder; only counts reach the driver. A node
    with many links is met by a join against rows that are unique by node, which AQE can split.
    """
    u, v = edges.columns
    edges = edges.select(F.greatest(u, v).cast("bigint").alias("u"), F.least(u, v).cast("bigint").alias("v"))
    edges = edges.filter("u <> v")
    rows = edges.count()
    edges = _stars(edges, rows)
    while not _settled(edges):
        moved = stored(_sized(_large_star(edges), rows), "large-stars")
        edges = _stars(_small_star(moved), rows)
    edges = edges.distinct()
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
