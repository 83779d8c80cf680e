"""Exact nearest neighbours by cosine, as a block matrix join over int8 tiles.

Vectors are packed into blocks: unit vectors as int8 with a scale, and the exact length of what rounding
took away. The integer product of two blocks, times the scales, differs from the cosines by at most
err_x |y^| + |x^| err_y + err_x err_y (Cauchy-Schwarz). A pair survives a tile only if its upper bound
reaches the k-th best known value of its query; survivors are computed again in double precision and go
into the query's heap. Heaps of the tasks are merged by one window. Nothing is approximate in the result.

Blocks of queries are broadcast while their measured size is below ``broadcast_bytes``; beyond that
blocks of candidates and of queries meet by block number, and skewed blocks are split by Spark.

Defined cases: vectors that are NULL, empty, zero, or hold NULL or non-finite numbers take no part; nor
do rows with a NULL id. Only vectors of one length are compared. The rows of one vec_id are one vector's
versions: a query never meets its own id, and a pair of ids counts once, with its best score. Ties go to
the smaller vec_id. A query with fewer candidates returns all. Equal vectors are compared once per block
and keep their k + 1 smallest ids, which are all that can be returned. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, stored


@dataclass(frozen=True)
class BlockParams:
    k: int = 5
    block: int = 4096
    query_block: int = 512
    broadcast_bytes: int = 64 << 20
    open_blocks: int = 64


# -- blocks -------------------------------------------------------------------

def in_order(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row-wise dot products, added up dimension by dimension."""
    total = np.zeros(len(x))
    for j in range(x.shape[1]):
        total += x[:, j] * y[:, j]
    return total


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 unit vectors, scales, lengths of the rounded vectors and of the rounding errors."""
    unit = x / np.sqrt((x * x).sum(1, keepdims=True))
    scale = np.abs(unit).max(1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    rounded = q * scale[:, None]
    return q, scale, np.linalg.norm(rounded, axis=1), np.linalg.norm(unit - rounded, axis=1)


def integer_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of int8 matrices, exactly: single precision holds sums over 1024 dimensions."""
    total = 0.0
    for k in range(0, a.shape[1], 1024):
        total = total + (a[:, k:k + 1024].astype(np.float32) @ b[:, k:k + 1024].astype(np.float32).T).astype(np.float64)
    return total


def usable(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places and values of the vectors that take part."""
    lists = column.cast(pa.list_(pa.float64()))
    flat, offsets = lists.values, np.asarray(lists.offsets)
    values = flat.to_numpy(zero_copy_only=False)  # NULL numbers become NaN
    sizes = np.diff(offsets)
    good = np.asarray(lists.is_valid()) & (sizes > 0)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    full = np.concatenate([[0], np.cumsum(np.nan_to_num(values) != 0)])
    good &= (bad[offsets[1:]] == bad[offsets[:-1]]) & (full[offsets[1:]] > full[offsets[:-1]])
    places = np.flatnonzero(good)
    # Numbers so small or large that squares vanish or overflow have no cosine in double precision.
    rows = [values[offsets[i]:offsets[i + 1]] for i in places]
    keep = [0 < (r * r).sum() < np.inf for r in rows]
    return places[keep], [r for r, ok in zip(rows, keep) if ok]


_BLOCK_DDL = "dim int, block bigint, n int, ids binary, vectors binary"
_BLOCK = pa.schema([("dim", pa.int32()), ("block", pa.int64()), ("n", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary())])


def packed(vectors: DataFrame, size: int, spare: int = 0) -> DataFrame:
    """Blocks of at most ``size`` vectors of one length, made where the rows are.

    With ``spare``, equal vectors of a block keep only that many smallest ids.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, waiting = TaskContext.get().partitionId() << 32, {}

        def block(dim: int) -> pa.RecordBatch:
            nonlocal number
            ids, x = np.array(waiting[dim][0], np.int64), np.array(waiting[dim][1])
            order = np.lexsort((ids, *x.T[::-1]))
            ids, x = ids[order], x[order]
            new = np.append(True, (x[1:] != x[:-1]).any(1))
            twin = np.append(False, (ids[1:] == ids[:-1]) & ~new[1:])
            ids, x, new = ids[~twin], x[~twin], new[~twin]
            if spare:
                first = np.flatnonzero(new)
                rank = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
                ids, x = ids[rank < spare], x[rank < spare]
            number += 1
            return pa.RecordBatch.from_pydict({"dim": [dim], "block": [number], "n": [len(ids)], "ids": [ids.tobytes()],
                                               "vectors": [x.tobytes()]}, _BLOCK)

        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            places, rows = usable(b.column(1))
            for i, r in zip(places, rows):
                ids_of, rows_of = waiting.setdefault(len(r), ([], []))
                ids_of.append(ids[i])
                rows_of.append(r)
                if len(ids_of) == size:
                    yield block(len(r))
                    del waiting[len(r)]
        for dim in sorted(waiting):
            yield block(dim)

    return map_batches(vectors, run, _BLOCK_DDL)


# -- tiles --------------------------------------------------------------------

class Heaps:
    """The k best of every query of one block, merged with the survivors of one tile after the other."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int):
        self.ids, self.x, self.k = ids, x, k
        self.q, self.scale, self.length, self.error = quantised(x)
        self.norm = np.sqrt(in_order(x, x))
        self.best = pd.DataFrame({"q": np.zeros(0, np.int64), "score": np.zeros(0), "id": np.zeros(0, np.int64)})
        self.least = np.full(len(ids), -np.inf)

    def meet(self, ids: np.ndarray, x: np.ndarray, coded) -> None:
        q, scale, length, error, norm, versions = coded
        near = integer_products(self.q, q) * self.scale[:, None] * scale[None, :]
        slack = (self.error[:, None] * length[None, :] + self.length[:, None] * error[None, :]
                 + self.error[:, None] * error[None, :] + 1e-9)
        near[self.ids[:, None] == ids[None, :]] = -np.inf
        floor = self.least.copy()
        rank = self.k * versions  # so many rows hold at least k ids
        if near.shape[1] >= rank:
            floor = np.maximum(floor, np.partition(near - slack, near.shape[1] - rank, axis=1)[:, near.shape[1] - rank])
        i, j = np.nonzero((near + slack >= floor[:, None]) & np.isfinite(near))
        found = []
        for a in range(0, len(i), 1 << 15):
            s, t = i[a:a + (1 << 15)], j[a:a + (1 << 15)]
            found.append(pd.DataFrame({"q": s, "score": in_order(self.x[s], x[t]) / (self.norm[s] * norm[t]), "id": ids[t]}))
        every = pd.concat([self.best, *found]).sort_values(["q", "score", "id"], ascending=[True, False, True])
        every = every.drop_duplicates(["q", "id"])
        self.best = every[every.groupby("q").cumcount() < self.k]
        full = self.best.groupby("q")["score"].agg(["size", "min"])
        full = full[full["size"] == self.k]
        self.least[full.index.to_numpy()] = full["min"].to_numpy()

    def rows(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.ids[self.best["q"].to_numpy(np.int64)]), pa.array(self.best["id"].to_numpy(np.int64)),
                                           pa.array(self.best["score"].to_numpy(float))], names=["query_id", "vec_id", "score"])


def tile_bests(tiles: DataFrame, p: BlockParams) -> DataFrame:
    """The best rows of each query in each task; a task keeps the heaps of ``open_blocks`` query blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, Heaps] = {}
        last, held = None, None
        for b in batches:
            for dim, block, ids, x, q_block, q_ids, q_x in zip(*(c.to_pylist() for c in b.columns)):
                if q_block not in heaps:
                    while len(heaps) >= p.open_blocks:
                        yield heaps.pop(next(iter(heaps))).rows()
                    heaps[q_block] = Heaps(np.frombuffer(q_ids, np.int64), np.frombuffer(q_x).reshape(-1, dim), p.k)
                if block != last:
                    c_ids, c_x = np.frombuffer(ids, np.int64), np.frombuffer(x).reshape(-1, dim)
                    versions = int(np.unique(c_ids, return_counts=True)[1].max())
                    held, last = (c_ids, c_x, (*quantised(c_x), np.sqrt(in_order(c_x, c_x)), versions)), block
                heaps[q_block].meet(*held)
        for h in heaps.values():
            yield h.rows()

    return map_batches(tiles.select("dim", "block", "ids", "vectors", "q_block", "q_ids", "q_vectors"), run,
                       "query_id bigint, vec_id bigint, score double")


def nearest(vectors: DataFrame, is_query: Column, p: BlockParams = BlockParams(), id_column: str = "vec_id",
            vector_column: str = "embedding") -> DataFrame:
    """query_id, rank from 1, vec_id and score of the k nearest candidates of every query."""
    held = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v")).where("vec_id IS NOT NULL")
    asked = vectors.where(is_query).select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v")).where("vec_id IS NOT NULL")
    count = asked.count()
    queries = stored(packed(asked.repartition(max(1, -(-count // p.query_block)), F.xxhash64("vec_id", "v")), p.query_block), "queries")
    sized = queries.agg(F.sum(F.length("ids") + F.length("vectors")).alias("bytes"), F.count("*").alias("blocks")).first()
    sides = queries.select("dim", F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    blocks = packed(held, p.block, p.k + 1)
    if (sized["bytes"] or 0) <= p.broadcast_bytes:
        tiles = blocks.join(F.broadcast(sides), "dim")
    else:
        # Each candidate block goes to the queries of its length, one query block after the other.
        numbers = sides.select("dim", "q_block")
        tiles = blocks.join(numbers, "dim").join(sides, ["dim", "q_block"])
    pairs = tile_bests(tiles, p).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= p.k)
            .select("query_id", "rank", "vec_id", "score"))
