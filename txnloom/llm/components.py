"""Connected components of links between integer ids, by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, stored

#: A task contracts so many links at once before the links of all tasks meet.
BLOCK = 1 << 17


def least_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some links, ascending, and the least node that each can reach by them."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    label = np.arange(len(nodes))
    while (label[a] != label[b]).any():
        np.minimum.at(label, np.maximum(label[a], label[b]), np.minimum(label[a], label[b]))
        while (label[label] != label).any():
            label = label[label]
    return nodes, nodes[label]


def _contracted(edges: DataFrame, block: int) -> DataFrame:
    """Links (u, v) with the same components: those of a block become stars around their least node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def stars() -> pa.RecordBatch:
            node, root = least_reachable(*(np.concatenate(x) for x in zip(*held)))
            return pa.RecordBatch.from_pydict({"u": node[node != root], "v": root[node != root]})

        for batch in batches:
            for k in range(0, batch.num_rows, block):
                held.append(tuple(np.asarray(c) for c in batch.slice(k, block).columns))
                size += len(held[-1][0])
                if size >= block:
                    yield stars()
                    held, size = [], 0
        if held:
            yield stars()

    return map_batches(edges.select("u", "v"), run, "u bigint, v bigint")


def _least(edges: DataFrame) -> DataFrame:
    """(u, v, m): every edge with the least of u and its neighbours; minima are combined before the shuffle."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").withColumn("m", F.least("u", "m"))


def _tangled(edges: DataFrame) -> bool:
    """Whether some node has two lesser neighbours, or one lesser and one larger: the edges are no stars yet."""
    ends = (edges.select(F.col("u").alias("node"), F.lit(1).alias("lesser"), F.lit(0).alias("larger"))
            .unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("lesser"), F.lit(1).alias("larger"))))
    nodes = ends.groupBy("node").agg(F.sum("lesser").alias("lesser"), F.max("larger").alias("larger"))
    return nodes.where("lesser > 1 OR lesser = 1 AND larger = 1").agg(F.count("*")).first()[0] > 0


def components(links: DataFrame, block: int = BLOCK) -> DataFrame:
    """(node, component): the smallest id that each linked id can reach; ids without links are absent.

    ``links`` has long columns a and b. Large-star links the larger neighbours of a node to the least
    node of its neighbourhood, small-star the smaller ones; both keep components and, repeated, leave
    stars. A third of all links at one node is no group: minima are partial sums and the join is split.
    Before that each task makes stars of its own links, ``block`` at a time, so long chains need few rounds.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    # Small tables are few blocks, so few tasks take them.
    edges = stored(_contracted(edges.coalesce(edges.count() // block + 1), block).distinct(), "contracted")
    while _tangled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        down = stored(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "large")
        small = _least(down)
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        edges = stored(small, "small")
    stars = edges.groupBy("u").agg(F.min("v").alias("v"))
    return (stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
