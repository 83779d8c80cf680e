"""Near-duplicates by a MinHash forest, every link confirmed on full shingle sets.

Texts with equal shingle sets form classes, and one document stands for each. Every representative has
32 signature orders (trees) of eight levels. In each order, sorted over the cluster, neighbours with the
longest common prefix are candidates: where many texts share a prefix, neighbours agree on more levels,
so the depth adapts to the region. So is each text of a region with the region's hub, the text nearest to
the majority of its sketches: copies of one text agree with it more than with each other. Candidates
pass a bit sketch and are confirmed on the full sets.

1. Neighbours and hubs in the first trees are confirmed and joined into components.
2. Those of all trees that still lie in different components follow.
3. A region is what shares the first three levels of a tree. Regions that still hold several components
   get ``hubs`` new hubs from their largest component, turn by turn, until a turn joins nothing; a turn
   names a few candidates per row.
4. What is then still apart in a region is compared in full, across components, in tiles of bounded size.
   A first pass names the texts that have a partner whose signature agrees enough; a second one brings their
   full sets to tiles and confirms there, so pairs below the similarity never become rows. A tile returns one
   link per pair of components. Nothing is capped.

A pair of similarity 0.75 shares a region of some tree with probability 1 - (1 - 0.75**3)**32, all but
3 in 100 million; sketch and signature keep it with probability above 1 - 1e-5.

Defined cases: NULL, empty and blank texts have no shingles and no links. A text of fewer than five
words is one shingle. NULL ids are in no group: component_id is NULL and kept is true. Rows that share an
id are one document. An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, small_batches, stored, words_of
from .components import components

LEVELS, REGION_LEVELS = 8, 3
_MULTIPLIERS = np.random.default_rng(5).integers(1, 2 ** 63, 6, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass(frozen=True)
class ForestParams:
    """``sketch_least`` of 128 bits and ``signature_least`` of the minima agree on pairs that are confirmed.

    A chunk of a tile has about ``tile`` texts and, with full sets, ``tile_shingles`` shingles (8 bytes each).
    Up to ``small_keys`` ids or regions are broadcast to what they select, more are joined.
    """

    words: int = 5
    percent: int = 75
    trees: int = 32
    first: int = 4
    sketch_least: int = 94
    signature_least: float = 0.62
    tile: int = 512
    tile_shingles: int = 1 << 20
    hubs: int = 8
    turns: int = 16
    small_keys: int = 1_000_000


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text."""
    from xxhash import xxh64_intdigest
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh64_intdigest, [w.lower() for w in words]), np.uint64, len(words))
    if len(h) < width:
        return _mix(np.array([(h * _MULTIPLIERS[:len(h)]).sum() + np.uint64(len(h))], np.uint64))
    total = h[:len(h) - width + 1] * _MULTIPLIERS[0]
    for k in range(1, width):
        total = total + h[k:len(h) - width + 1 + k] * _MULTIPLIERS[k % 6]
    return np.unique(_mix(total))


def signature(hashes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Minima under all seeds, mixed to 16 bits each, for a non-empty set."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)[None, :]
    low = np.full(len(seeds), 2 ** 32 - 1, np.uint32)
    for k in range(0, x.shape[1], 1024):
        np.minimum(low, (x[:, k:k + 1024] * seeds).min(1), out=low)
    return (_mix(low.astype(np.uint64) + np.arange(len(seeds), dtype=np.uint64) * np.uint64(2 ** 33)) >> np.uint64(40)).astype(np.uint16)


def _seeds(p: ForestParams) -> np.ndarray:
    return (np.random.default_rng(11).integers(0, 2 ** 31, (p.trees * LEVELS, 1), dtype=np.uint32) * np.uint32(2)
            + np.uint32(1))


def described(docs: DataFrame, p: ForestParams) -> DataFrame:
    """doc_id, n_shingles, class of equal sets (NULL for an empty set) and signature of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest
        seeds = _seeds(p)
        for b in small_batches(batches, 1):
            n, cls, sig = [], [], []
            for text in b.column(1).to_pylist():
                s = shingle_set(text, p.words)
                n.append(len(s))
                cls.append(xxh3_128_digest(s.tobytes()) if len(s) else None)
                sig.append(signature(s, seeds).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.binary()),
                                              pa.array(sig, pa.binary())], names=["doc_id", "n", "cls", "sig"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id bigint, n bigint, cls binary, sig binary")


_TREE_DDL = "tree int, hi bigint, lo bigint, rep bigint, n bigint, b1 bigint, b2 bigint"


def tree_rows(reps: DataFrame, p: ForestParams, trees: int | None = None) -> DataFrame:
    """One row per representative and tree: the levels packed for sorting, the set size and the sketch.

    A component of the representatives stays on their rows.
    """
    count = p.trees if trees is None else trees
    kept = ["component"] if "component" in reps.columns else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint16).reshape(b.num_rows, p.trees, LEVELS)
            big = sig.astype(np.uint64)
            hi, lo = (sum(big[:, :count, k + j] << np.uint64(48 - 16 * j) for j in range(4)) for k in (0, 4))
            hi = (hi ^ np.uint64(2 ** 63)).view(np.int64)
            lo = (lo ^ np.uint64(2 ** 63)).view(np.int64)
            bits = np.packbits((sig.reshape(b.num_rows, -1)[:, :128] & 1).astype(np.uint8), axis=1).view(np.int64)
            each = lambda x: np.repeat(x, count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (np.tile(np.arange(count, dtype=np.int32), b.num_rows), hi.ravel(), lo.ravel(),
                                       each(b.column(0).to_numpy()), each(b.column(1).to_numpy()),
                                       each(bits[:, 0]), each(bits[:, 1]), *(each(b.column(3).to_numpy()) for _ in kept))],
                names=["tree", "hi", "lo", "rep", "n", "b1", "b2", *kept])

    return map_batches(reps.select("rep", "n", "sig", *kept), run, _TREE_DDL + "".join(f", {c} bigint" for c in kept))


def _close(n1, n2, a1, a2, b1, b2, p: ForestParams) -> np.ndarray:
    """Size ratio and sketch allow a link."""
    same = 128 - np.bitwise_count((a1 ^ b1).view(np.uint64)).astype(np.int64) - np.bitwise_count((a2 ^ b2).view(np.uint64))
    return (same >= p.sketch_least) & (100 * np.minimum(n1, n2) >= p.percent * np.maximum(n1, n2))


def _hubs(tree, hi, rep, n, b1, b2, p: ForestParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hub, member, tree) for every region of at least four sorted rows."""
    region = hi >> 16
    starts = np.flatnonzero(np.append(True, (tree[1:] != tree[:-1]) | (region[1:] != region[:-1])))
    ends = np.append(starts[1:], len(tree))
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32))]
    for s, e in zip(starts[ends - starts > 3], ends[ends - starts > 3]):
        words = np.stack([b1[s:e], b2[s:e]], 1)
        bits = np.unpackbits(words.view(np.uint8), axis=1)
        far = (bits != (2 * bits.sum(0, dtype=np.int64) >= e - s)).sum(1)
        hub = s + np.lexsort((rep[s:e], far))[0]
        at = np.arange(s, e)
        ok = _close(n[at], n[hub], b1[at], b2[at], b1[hub], b2[hub], p) & (rep[at] != rep[hub])
        found.append((np.full(ok.sum(), rep[hub]), rep[at[ok]], tree[at[ok]]))
    return tuple(np.concatenate(x) for x in zip(*found))


def neighbours(rows: DataFrame, p: ForestParams) -> DataFrame:
    """Candidates (a, b, tree): next to each other in the sorted trees, or member and hub, in one region.

    A task also returns its first and last row, so that neighbours across two tasks are found too.
    """
    ordered = rows.repartitionByRange("tree", "hi", "lo", "rep").sortWithinPartitions("tree", "hi", "lo", "rep")
    names = ["tree", "hi", "lo", "rep", "n", "b1", "b2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, first = TaskContext.get().partitionId(), None, True
        for b in batches:
            if not b.num_rows:
                continue
            cols = [np.asarray(b.column(names.index(c))) for c in names]
            ends = [c[:1] for c in cols] if first else []
            if last is not None:
                cols = [np.concatenate([x, c]) for x, c in zip(last, cols)]
            tree, hi, _, rep, n, b1, b2 = cols
            ok = (tree[1:] == tree[:-1]) & (hi[1:] >> 16 == hi[:-1] >> 16) & (rep[1:] != rep[:-1])
            ok &= _close(n[1:], n[:-1], b1[1:], b2[1:], b1[:-1], b2[:-1], p)
            yield _pairs(rep[:-1][ok], rep[1:][ok], tree[1:][ok])
            yield _pairs(*_hubs(tree, hi, rep, n, b1, b2, p))
            if first:
                yield _edge(part, 0, ends)
                first = False
            last = [c[-1:] for c in cols]
        if last is not None:
            yield _edge(part, 1, last)

    found = stored(map_batches(ordered, run, f"a bigint, b bigint, side bigint, {_TREE_DDL}"), "neighbours")
    inner = found.where("side is null").select("a", "b", "tree")
    # Two rows per task of the sort: few, whatever the data.
    w = Window.orderBy("side")
    ends = found.where("side is not null").select("side", *names)
    before = [F.lag(c).over(w).alias(f"p_{c}") for c in names]
    across = (ends.select("*", *before).where("tree = p_tree AND shiftright(hi, 16) = shiftright(p_hi, 16) AND rep <> p_rep")
              .where(f"100 * least(n, p_n) >= {p.percent} * greatest(n, p_n)").select(
                  F.col("p_rep").alias("a"), F.col("rep").alias("b"), "tree"))
    return inner.unionByName(across).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "tree")


_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("side", pa.int64()), ("tree", pa.int32()),
                    *[(c, pa.int64()) for c in ("hi", "lo", "rep", "n", "b1", "b2")]])


def _pairs(a, b, tree) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), none, pa.array(tree, pa.int32()), *[none] * 6], schema=_FOUND)


def _edge(part: int, side: int, row: list) -> pa.RecordBatch:
    none = pa.nulls(1, pa.int64())
    return pa.RecordBatch.from_arrays([none, none, pa.array([2 * part + side]), pa.array(row[0], pa.int32()),
                                       *[pa.array(x, pa.int64()) for x in row[1:]]], schema=_FOUND)


def full_sets(docs: DataFrame, ids: DataFrame, p: ForestParams) -> DataFrame:
    """(rep, hashes) of the documents with these ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 1):
            sets = [shingle_set(t, p.words).view(np.int64) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["rep", "hashes"])

    wanted = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").join(ids, "rep", "left_semi")
    return map_batches(wanted, run, "rep bigint, hashes array<bigint>")


def confirmed(pairs: DataFrame, sets: DataFrame, p: ForestParams) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    left = sets.select(F.col("rep").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("rep").alias("b"), F.col("hashes").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return (pairs.join(left, "a").join(right, "b").withColumn("common", common)
            .where(100 * F.col("common") >= p.percent * (F.size("x") + F.size("y") - F.col("common")))
            .select("a", "b"))


def _labelled(rows: DataFrame, label: DataFrame) -> DataFrame:
    """Rows with the component of their text."""
    return (rows.join(label.withColumnRenamed("node", "rep"), "rep", "left")
            .withColumn("component", F.coalesce("component", "rep")))


def mixed_rows(rows: DataFrame, label: DataFrame, p: ForestParams = ForestParams()) -> DataFrame:
    """The rows of all trees that lie in a region with several components; joins only make them fewer.

    Rows that bring their component are not joined with ``label``.
    """
    rows = rows.withColumn("region", F.shiftright("hi", 16)).drop("hi", "lo")
    known = rows if "component" in rows.columns else _labelled(rows, label)
    mixed = known.groupBy("tree", "region").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    # Most regions hold one text: only their least and largest component move, not the rows.
    mixed = stored(mixed.select("tree", "region"), "mixed")
    if mixed.count() <= p.small_keys:
        mixed = F.broadcast(mixed)
    return known.join(mixed, ["tree", "region"], "left_semi").drop("component")


def hub_pairs(rows: DataFrame, reps: DataFrame, label: DataFrame, turn: int, p: ForestParams) -> DataFrame:
    """Candidates of a few hubs with all that is apart from them in their region.

    A region's hubs come from its largest component and change with ``turn``. In a region where each two
    texts are linked with some chance, every hub ties that share of what is apart to the largest component,
    so some turns leave little; a turn names at most ``hubs`` candidates per row.
    """
    known = _labelled(rows, label)
    # The order does not depend on the tree, so trees that share a crowd tend to name the same pairs.
    order = F.xxhash64(F.lit(turn), F.col("rep"))
    hub = F.struct(order.alias("order"), *[F.col(c).alias(f"h_{c}") for c in ("rep", "n", "b1", "b2")])
    slots = (known.groupBy("tree", "region", "component", F.pmod(order, F.lit(p.hubs)).alias("slot"))
             .agg(F.count("*").alias("members"), F.min(hub).alias("hub")))
    kinds = slots.groupBy("tree", "region", "component").agg(F.sum("members").alias("members"), F.collect_list("hub").alias("hubs"))
    tops = (kinds.groupBy("tree", "region").agg(F.max_by(F.struct(F.col("component").alias("top"), "hubs"), F.struct("members", "component")).alias("top"),
                                                F.count("*").alias("kinds"))
            .where("kinds > 1").select("tree", "region", "top.top", "top.hubs"))

    def close(h):
        same = 128 - F.bit_count(F.col("b1").bitwiseXOR(h["h_b1"])) - F.bit_count(F.col("b2").bitwiseXOR(h["h_b2"]))
        return (same >= p.sketch_least) & (100 * F.least("n", h["h_n"]) >= p.percent * F.greatest("n", h["h_n"]))

    # A hub becomes a row only where sizes and sketches allow a link.
    named = (known.join(tops, ["tree", "region"]).where("component <> top")
             .select("rep", "n", "b1", "b2", F.explode(F.filter("hubs", close)).alias("hub"))
             .select("rep", "n", "b1", "b2", *[f"hub.h_{c}" for c in ("rep", "n", "b1", "b2")]).distinct())
    both = (named.join(reps.select("rep", "sig"), "rep")
            .join(reps.select(F.col("rep").alias("h_rep"), F.col("sig").alias("h_sig")), "h_rep")
            .select("rep", "n", "b1", "b2", "h_rep", "h_n", "h_b1", "h_b2", "sig", "h_sig"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rep, n, b1, b2, h, hn, hb1, hb2 = (np.asarray(c) for c in batch.columns[:8])
            one, two = (np.frombuffer(b"".join(c.to_pylist()), np.uint16).reshape(len(rep), -1) for c in batch.columns[8:])
            ok = _close(n, hn, b1, b2, hb1, hb2, p) & ((one == two).sum(1) >= p.signature_least * one.shape[1])
            yield pa.RecordBatch.from_pydict({"a": np.minimum(rep, h)[ok], "b": np.maximum(rep, h)[ok]})

    return map_batches(both, run, "a bigint, b bigint")


def _chunked(rows: DataFrame, label: DataFrame, with_sets: bool, p: ForestParams) -> DataFrame:
    """The rows of regions with several components, each region dealt into chunks of bounded size."""
    known = _labelled(rows, label)
    chunks = F.ceil(F.count("*") / p.tile)
    if with_sets:
        chunks = F.greatest(chunks, F.ceil(F.sum("n") / p.tile_shingles))
    mixed = (known.groupBy("tree", "region").agg(chunks.cast("int").alias("chunks"), F.min("component").alias("low"),
                                                 F.max("component").alias("high"))
             .where("low < high").select("tree", "region", "chunks"))
    return known.join(mixed, ["tree", "region"]).withColumn("chunk", F.pmod(F.xxhash64("rep"), "chunks").cast("int"))


def _placed(chunked: DataFrame, *payloads: DataFrame) -> DataFrame:
    """One row per text: its places in all trees (one per tree at most), and what the payloads hold by ``rep``."""
    held = (chunked.groupBy("rep", "n", "b1", "b2", "component")
            .agg(F.collect_list(F.struct("tree", "region", "chunk", "chunks")).alias("places")))
    for payload in payloads:
        held = held.join(payload, "rep")
    return held


_TILE_KEYS = ["tree", "region", "c1", "c2"]
_TILE_NUMBERS = [*_TILE_KEYS, "chunk", "rep", "n", "b1", "b2", "component"]


def _objects(column: pa.Array) -> np.ndarray:
    """Bytes, or one array per list, as objects."""
    out = np.empty(len(column), object)
    if pa.types.is_list(column.type):
        ends = column.offsets.to_numpy()
        parts = np.split(column.flatten().to_numpy(), ends[1:-1] - ends[0])
    else:
        parts = column.to_pylist()
    for k, part in enumerate(parts):
        out[k] = part
    return out


def _in_tiles(held: DataFrame, tile: Callable[[dict], dict], ddl: str, payload: list[str]) -> DataFrame:
    """``tile`` on the rows of every two chunks of a region, as a dict of arrays by column."""
    names = [*_TILE_NUMBERS, *payload]
    each = held.select("rep", "n", "b1", "b2", "component", *payload, F.explode("places").alias("place")).select("place.*", "*").drop("place")
    cells = each.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "tree", "region", F.least("chunk", "other").alias("c1"), F.greatest("chunk", "other").alias("c2"), *names[4:])
    dealt = cells.repartition(*_TILE_KEYS).sortWithinPartitions(*_TILE_KEYS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_over: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [np.asarray(c) if k < len(_TILE_NUMBERS) else _objects(c) for k, c in enumerate(batch.columns)]
            if held_over is not None:
                cols = [np.concatenate([x, y]) for x, y in zip(held_over, cols)]
            change = np.zeros(len(cols[0]) - 1, bool)
            for c in cols[:4]:
                change |= c[1:] != c[:-1]
            starts = [0, *(np.flatnonzero(change) + 1).tolist()]
            for s, e in zip(starts, starts[1:]):
                yield pa.RecordBatch.from_pydict(tile(dict(zip(names, (c[s:e] for c in cols)))))
            held_over = [c[starts[-1]:] for c in cols]
        if held_over is not None:
            yield pa.RecordBatch.from_pydict(tile(dict(zip(names, held_over))))

    return map_batches(dealt, run, ddl)


def _agreeing(c: dict, p: ForestParams) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a tile in different components whose sizes, sketches and signatures allow a link.

    A pair appears in the first tree in which it shares a region, and in no other.
    """
    chunk, comp, n, b1, b2 = (c[k] for k in ("chunk", "component", "n", "b1", "b2"))
    sig = np.frombuffer(b"".join(c["sig"]), np.uint16).reshape(len(n), -1)
    least = p.signature_least * sig.shape[1]
    regions = sig.reshape(len(n), p.trees, LEVELS)[:, :, :REGION_LEVELS]
    low, high = c["c1"][0], c["c2"][0]
    one, two = np.flatnonzero(chunk == low), np.flatnonzero(chunk == high)
    for k in range(0, len(one), 256):
        i, j = np.broadcast_arrays(one[k:k + 256, None], two[None, :])
        ok = (comp[i] != comp[j]) & ((i < j) | (low != high))
        i, j = i[ok], j[ok]
        ok = _close(n[i], n[j], b1[i], b2[i], b1[j], b2[j], p)
        i, j = i[ok], j[ok]
        for s in range(0, len(i), 4096):
            i_of, j_of = i[s:s + 4096], j[s:s + 4096]
            ok = (sig[i_of] == sig[j_of]).sum(1) >= least
            i_of, j_of = i_of[ok], j_of[ok]
            ok = (regions[i_of] == regions[j_of]).all(2).argmax(1) == c["tree"][0]
            yield i_of[ok], j_of[ok]


def crowded_pairs(rows: DataFrame, reps: DataFrame, label: DataFrame, p: ForestParams) -> DataFrame:
    """Candidates (a, b) between different components of one region, every pair looked at, tile by tile."""
    def tile(c: dict) -> dict:
        found = [*_agreeing(c, p), (np.zeros(0, np.int64),) * 2]
        a, b = (c["rep"][np.concatenate(x)] for x in zip(*found))
        return {"a": np.minimum(a, b), "b": np.maximum(a, b)}

    held = _placed(_chunked(rows, label, False, p), reps.select("rep", "sig"))
    return _in_tiles(held, tile, "a bigint, b bigint", ["sig"]).distinct()


def crowded_ends(rows: DataFrame, reps: DataFrame, label: DataFrame, p: ForestParams) -> DataFrame:
    """(tree, region, rep) of the texts that may have a link to another component of the region."""
    def tile(c: dict) -> dict:
        ends = np.zeros(len(c["rep"]), bool)
        for i, j in _agreeing(c, p):
            ends[i] = ends[j] = True
        return {k: c[k][ends] for k in ("tree", "region", "rep")}

    held = _placed(_chunked(rows, label, False, p), reps.select("rep", "sig"))
    return _in_tiles(held, tile, "tree int, region bigint, rep bigint", ["sig"]).distinct()


def _common(i: np.ndarray, j: np.ndarray, sets: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sets."""
    if not len(i):
        return np.zeros(0, np.int64)
    used, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    held = [sets[k] for k in used]
    ends = np.cumsum([0, *map(len, held)])
    place = np.unique(np.concatenate(held), return_inverse=True)[1]
    i, j = at[:len(i)], at[len(i):]
    mark, out = np.zeros(place.max() + 1, bool), np.zeros(len(i), np.int64)
    order = np.argsort(i, kind="stable")
    for run in np.split(order, np.flatnonzero(np.diff(i[order])) + 1):
        mine = place[ends[i[run[0]]]:ends[i[run[0]] + 1]]
        mark[mine] = True
        for k in run:
            out[k] = np.count_nonzero(mark[place[ends[j[k]]:ends[j[k] + 1]]])
        mark[mine] = False
    return out


def crowded_links(rows: DataFrame, ends: DataFrame, reps: DataFrame, label: DataFrame, sets: DataFrame, p: ForestParams) -> DataFrame:
    """Confirmed links (a, b) between ``ends`` of different components; one per tile and pair of components."""
    def tile(c: dict) -> dict:
        a, b, done = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.zeros((0, 2), np.int64)
        sizes = np.array([len(s) for s in c["hashes"]], np.int64)
        for i, j in _agreeing(c, p):
            common = _common(i, j, c["hashes"])
            ok = 100 * common >= p.percent * (sizes[i] + sizes[j] - common)
            i, j = i[ok], j[ok]
            kinds = np.stack([np.minimum(c["component"][i], c["component"][j]), np.maximum(c["component"][i], c["component"][j])], 1)
            both, first = np.unique(np.concatenate([done, kinds]), axis=0, return_index=True)
            new = first[first >= len(done)] - len(done)
            a.append(c["rep"][i[new]])
            b.append(c["rep"][j[new]])
            done = both
        a, b = np.concatenate(a), np.concatenate(b)
        return {"a": np.minimum(a, b), "b": np.maximum(a, b)}

    held = _placed(_chunked(rows.join(ends, ["tree", "region", "rep"], "left_semi"), label, True, p), reps.select("rep", "sig"), sets)
    return _in_tiles(held, tile, "a bigint, b bigint", ["sig", "hashes"]).distinct()


def _joined(label: DataFrame, more: DataFrame) -> DataFrame:
    """Links that give the components of ``label`` joined by ``more``: one per node instead of all."""
    return label.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)


def _extended(label: DataFrame, more: DataFrame, name: str) -> DataFrame:
    """Components of all links with stored ``more``; without any, they are the same."""
    return stored(components(_joined(label, more)), name) if more.limit(1).count() else label


def near_duplicates(docs: DataFrame, p: ForestParams = ForestParams()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row."""
    every = stored(described(docs, p), "signatures")
    classes = every.where("doc_id IS NOT NULL AND cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("rep"))
    classes = stored(classes, "classes")
    reps = stored(every.join(classes.withColumnRenamed("rep", "doc_id"), ["cls", "doc_id"])
                  .select(F.col("doc_id").alias("rep"), "n", "sig", "cls").dropDuplicates(["rep", "cls"]).drop("cls"), "representatives")
    rows_of = every.where("doc_id IS NOT NULL").select("doc_id", "n", "cls").join(classes, "cls", "left")
    # Rows that share an id are one document: their classes are linked.
    ids = (rows_of.where("cls IS NOT NULL").groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("top")).where("b < top"))
    links = (rows_of.join(ids, "doc_id").select(F.col("rep").alias("a"), "b").where("a <> b")
             .unionByName(ids.select(F.col("doc_id").alias("a"), "b").where("a <> b"))).distinct()

    found = stored(neighbours(tree_rows(reps, p), p), "candidates")
    near = stored(found.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), "near")
    sets = stored(full_sets(docs, near, p), "sets")
    # A representative that shares its id with another text stands for both in links; its sets do not mix.
    first = confirmed(found.where(F.col("tree") < p.first).select("a", "b").distinct(), sets, p)
    links = stored(links.unionByName(first), "links-first")
    label = stored(components(links), "label-first")

    def apart(pairs: DataFrame) -> DataFrame:
        """Pairs whose ends are not yet connected."""
        a = label.select(F.col("node").alias("a"), F.col("component").alias("ca"))
        b = label.select(F.col("node").alias("b"), F.col("component").alias("cb"))
        return (pairs.join(a, "a", "left").join(b, "b", "left")
                .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"))

    second = stored(confirmed(apart(found.select("a", "b").distinct()), sets, p), "links-second")
    label = _extended(label, second, "label-second")

    tried = found.select("a", "b").distinct()

    def with_sets_of(ends: DataFrame, sets: DataFrame, near: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Sets and their ids, with those that are needed besides."""
        more = stored(ends.distinct().join(near, "rep", "left_anti"), "near-more")
        return sets.unionByName(stored(full_sets(docs, more, p), "sets-more")), near.unionByName(more)

    # What neighbours and hubs left apart in a crowd: new hubs, until a turn joins nothing.
    crowd = stored(mixed_rows(tree_rows(_labelled(reps, label), p), label, p), "crowd")
    for turn in range(p.turns):
        pairs = stored(hub_pairs(crowd, reps, label, turn, p).join(tried, ["a", "b"], "left_anti"), "hub-pairs")
        sets, near = with_sets_of(pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))), sets, near)
        more = stored(confirmed(pairs, sets, p), "links-hubs")
        tried = tried.unionByName(pairs)
        if not more.limit(1).count():
            break
        label = _extended(label, more, "label-hubs")

    ends = stored(crowded_ends(crowd, reps, label, p), "crowded")
    sets, _ = with_sets_of(ends.select("rep"), sets, near)
    label = _extended(label, stored(crowded_links(crowd, ends, reps, label, sets, p), "links-crowded"), "label-crowded")

    joined = (rows_of.withColumn("rep", F.coalesce("rep", "doc_id"))
              .join(label.withColumnRenamed("node", "rep"), "rep", "left")
              .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id")))
    nameless = every.where("doc_id IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return joined.unionByName(nameless).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one_per_group(docs: DataFrame, p: ForestParams = ForestParams()) -> DataFrame:
    """The documents, all columns, of which one stays per group; of rows that share an id one stays.

    Rows with a NULL id all stay. Ids are joined as they are; only rows with a repeated id are sorted out
    by their whole content. Ids that do not simply stay are broadcast if they are few, else joined.
    """
    groups = stored(near_duplicates(docs.select("doc_id", "text"), p), "groups")
    named = groups.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("kept").alias("kept"), F.count("*").alias("rows"))
    # Most documents stay, so the few other ids are looked up, by broadcast where they are few enough: no text moves then.
    other = stored(named.where("NOT kept OR rows > 1"), "not-kept")
    many = other.where("kept AND rows > 1").select("doc_id")
    other = other.select("doc_id")
    if other.count() <= 2 * p.small_keys:  # one number each, regions are two
        other, many = F.broadcast(other), F.broadcast(many)
    single = docs.join(other, "doc_id", "left_anti")
    # Rows of one id differ in content or not at all: the least digest of all columns says which one stays.
    digest = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), {"ignoreNullFields": "false"}), 256)
    held = docs.join(many, "doc_id", "left_semi").withColumn("_digest", digest)
    least = held.groupBy("doc_id").agg(F.min("_digest").alias("_digest"))
    repeated = held.join(least, ["doc_id", "_digest"], "left_semi").dropDuplicates(["doc_id", "_digest"]).select(*docs.columns)
    return single.select(*docs.columns).unionByName(repeated)
