"""Language-model scores by context-tree weighting over bytes.

Texts are lower-cased words with one blank between them and a line feed as end, read as bytes. A byte is
eight binary decisions; for each decision and each context of up to ``depth`` bytes before it, training
texts give the numbers of zeros and ones. Krichevsky-Trofimov estimates of all depths are mixed with the
weights of the context tree: a node's weighted probability is half its own estimate plus half the product
of its children's. A byte's probability is the product over its decisions; its cost is the code length.

How it is spread: texts are cut into chunks of some megabytes. A chunk lists its distinct (context, byte)
grams and words with their training counts, dealt to parts by the three nearest context bytes or the word
hash. Lists of a part are added in groups of at most ``bucket_chunks`` chunks, then their sums in further
groups, until a part has one list of distinct keys. A part holds whole subtrees from depth 3 down; depth 2
is added up over the parts by an aggregate and joined back. Depths 0 and 1 are at most 256 * 255 nodes,
whatever the corpus; they alone pass the driver. Each bucket of chunks then meets the finished part and
gets answers for just its own grams: no task ever holds all chunks' lists of one context. Chunk and answers
meet at last, and every document is scored. Log probabilities of grams travel in single precision; sums are double. All documents are counted and scored; nothing is capped.

Defined cases: NULL and empty texts are the end alone. A NULL doc_id trains and is not held out. Repeated
rows count and are scored each. Without training texts every decision has probability 1/2. Words are
told apart by 64-bit hashes. A very long text is a chunk of its own. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import id_hash, map_batches, small_batches, stored, words_of

END = b"\n"
DEALT = 3  # context bytes by which grams are dealt to parts
FAN_IN = 64  # lists of sums that are added at once


@dataclass(frozen=True)
class ContextParams:
    """``depth`` context bytes, at least 2 and at most 7; ``chunk_bytes`` of text are answered at once,

    and a task holds a part's lists of about ``bucket_chunks`` chunks."""

    depth: int = 5
    chunk_bytes: int = 6 << 20
    parts: int = 0
    bucket_chunks: int = 512


# -- numbers ------------------------------------------------------------------

def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural log of the gamma function for x >= 0.5, by Stirling's series above 10."""
    x = np.asarray(x, float)
    shift, y = np.zeros_like(x), x.copy()
    for _ in range(10):
        low = y < 10
        shift += np.where(low, np.log(y), 0.0)
        y = np.where(low, y + 1, y)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7) - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - np.log(np.pi) - log_gamma(zeros + ones + 1.0)


def weighted(zeros, ones, children) -> np.ndarray:
    """Log weighted probability of inner nodes; ``children`` is the sum over their children."""
    return np.logaddexp(log_kt(zeros, ones), children) - np.log(2)


def decisions(symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decision nodes (1 to 255) and bits of byte values, one column per decision."""
    level = np.arange(8, dtype=np.uint64)
    s = symbol.astype(np.uint64)[:, None]
    return (np.uint64(1) << level) | (s >> (np.uint64(8) - level)), (s >> (np.uint64(7) - level)) & np.uint64(1)


def above(ids: np.ndarray) -> np.ndarray:
    """Ids of the nodes without their farthest context byte; an id is context bytes, then the decision."""
    return ((ids >> np.uint64(16)) << np.uint64(8)) | (ids & np.uint64(255))


class Subtrees:
    """Depths ``DEALT`` (or ``depth``, if less) to ``depth`` of the trees over sorted distinct grams (contexts first, nearest byte highest)."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, depth: int):
        node, self.bit = decisions(grams & np.uint64(255))
        self.node = node
        ids = ((grams >> np.uint64(8)) << np.uint64(8))[:, None] | node
        own, at = np.unique(ids.ravel(), return_inverse=True)
        weight = np.repeat(counts.astype(float), 8)
        bits = self.bit.ravel() == 1
        ones = np.bincount(at, weight * bits, len(own))
        zeros = np.bincount(at, weight * ~bits, len(own))
        log_pw = log_kt(zeros, ones)
        self.levels = [(at.reshape(ids.shape), zeros, ones, None)]
        for d in range(depth - 1, DEALT - 1, -1):
            own, up = np.unique(above(own), return_inverse=True)
            zeros, ones, below = (np.bincount(up, v, len(own)) for v in (zeros, ones, log_pw))
            log_pw = weighted(zeros, ones, below)
            stay = np.exp(log_kt(zeros, ones) - np.log(2) - log_pw)
            self.levels.append((up[self.levels[-1][0]], zeros, ones, stay))
        self.top, self.zeros, self.ones, self.log_pw = own, zeros, ones, log_pw
        # The depth 2 node of every top node.
        self.second, self.up = np.unique(above(own) if depth > 2 else own, return_inverse=True)

    def ratios(self) -> np.ndarray:
        """Mixed probability of every gram's decisions from the top of the subtrees down."""
        mixed = None
        for at, zeros, ones, stay in self.levels:
            z, o = zeros[at], ones[at]
            kt = (np.where(self.bit == 1, o, z) + 0.5) / (z + o + 1.0)
            mixed = kt if mixed is None else stay[at] * kt + (1 - stay[at]) * mixed
        return mixed


def shallow_table(nodes: np.ndarray, below: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """(nearest byte, decision) -> probability of 0 and of 1 without the deeper part, and its weight.

    ``nodes`` are byte * 256 + decision; ``below`` sums the weighted logs of depth 2.
    """
    z1, o1, b1 = (np.zeros((256, 256)) for _ in range(3))
    for into, v in ((z1, zeros), (o1, ones), (b1, below)):
        into.ravel()[nodes] = v
    w1 = weighted(z1, o1, b1)
    stay1 = np.exp(log_kt(z1, o1) - np.log(2) - w1)
    z0, o0, b0 = z1.sum(0), o1.sum(0), w1.sum(0)
    stay0 = np.exp(log_kt(z0, o0) - np.log(2) - weighted(z0, o0, b0))[None, :]
    kt = lambda n, z, o: (n + 0.5) / (z + o + 1.0)
    return np.stack([stay0 * kt(n0, z0, o0)[None, :] + (1 - stay0) * stay1 * kt(n1, z1, o1)
                     for n0, n1 in ((z0, z1), (o0, o1))] + [(1 - stay0) * (1 - stay1)], axis=-1)


# -- packing ------------------------------------------------------------------

def pack(values: np.ndarray) -> bytes:
    """64-bit integers as compressed byte planes."""
    import zstandard
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, dtype=np.uint64) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


# -- chunks -------------------------------------------------------------------

def normal_bytes(text: str | None) -> bytes:
    return b" ".join([w.lower() for w in words_of(text)]) + END


def gram_codes(payload: bytes, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct grams of a payload, the place of each byte's gram among them, and the end place of each document."""
    raw = np.frombuffer(payload, np.uint8)
    ends = np.flatnonzero(raw == END[0])
    starts = np.append(0, ends[:-1] + 1)
    # How many bytes of its own document stand before each byte, up to the depth.
    inside = np.full(len(raw), depth, np.uint8)
    for k in range(depth - 1, -1, -1):
        place = starts[starts + k <= ends] + k
        inside[place] = k
    keys = raw.astype(np.uint64)
    for k in range(1, depth + 1):
        before = np.full(len(raw), END[0], np.uint8)
        before[k:] = raw[:-k]
        before[inside < k] = END[0]
        wide = before.astype(np.uint64)
        wide <<= np.uint64(8 * (depth + 1 - k))
        keys |= wide
    coded = pa.array(keys).dictionary_encode()
    return coded.dictionary.to_numpy(), coded.indices.to_numpy(), ends


def word_codes(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words, the place of each word among them, and the document of each word."""
    from xxhash import xxh64_intdigest
    docs = pa.array(payload.split(END)[:-1], pa.large_binary())
    lists = pc.split_pattern(docs, " ")
    coded = lists.flatten().dictionary_encode()
    of = np.repeat(np.arange(len(docs)), np.diff(np.asarray(lists.offsets)))
    words = coded.dictionary.to_pylist()
    hashes = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    place = coded.indices.to_numpy()
    if b"" in words:  # the document without words
        real = place != words.index(b"")
        place, of = place[real], of[real]
    return hashes, place, of


def _end_hash() -> int:
    from xxhash import xxh64_intdigest
    return xxh64_intdigest(END)


def gram_parts(grams: np.ndarray, depth: int, parts: int) -> np.ndarray:
    """Part of each gram, by its ``DEALT`` nearest context bytes."""
    near = grams >> np.uint64(8 * (depth + 1 - min(DEALT, depth)))
    return ((near * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(parts)


def word_parts(hashes: np.ndarray, parts: int) -> np.ndarray:
    return (hashes >> np.uint64(7)) % np.uint64(parts)


def _wanted_words(hashes: np.ndarray, place: np.ndarray) -> np.ndarray:
    return np.unique(np.append(hashes[np.unique(place)], np.uint64(_end_hash())))


_CHUNK_DDL = "kind int, chunk bigint, part int, ids array<bigint>, held array<int>, keys binary, counts binary"
_CHUNK = pa.schema([("kind", pa.int32()), ("chunk", pa.int64()), ("part", pa.int32()), ("ids", pa.list_(pa.int64())),
                    ("held", pa.list_(pa.int32())), ("keys", pa.binary()), ("counts", pa.binary())])


def chunked(docs: DataFrame, p: ContextParams, parts: int) -> DataFrame:
    """Chunk rows (kind 0: ids and packed text) and what they need from the parts (1: grams, 2: words)."""
    def rows_of(chunk: int, ids: list, held: list, texts: list[bytes]) -> pa.RecordBatch:
        import zstandard
        payload = b"".join(texts)
        rows = [(0, chunk, -1, ids, held, zstandard.ZstdCompressor(level=3).compress(payload), None)]
        trains = np.array(held) == 0
        grams, place, ends = gram_codes(payload, p.depth)
        counts = np.bincount(place, np.repeat(trains, np.diff(np.append(-1, ends))), len(grams)).astype(np.int64)
        order = np.argsort(grams)
        grams, counts = grams[order], counts[order]
        hashes, wplace, of = word_codes(payload)
        wanted = _wanted_words(hashes, wplace)
        wcounts = np.bincount(np.searchsorted(wanted, hashes[wplace]), trains[of], len(wanted)).astype(np.int64)
        wcounts[np.searchsorted(wanted, np.uint64(_end_hash()))] += trains.sum()
        for kind, keys, n, part in ((1, grams, counts, gram_parts(grams, p.depth, parts)),
                                    (2, wanted, wcounts, word_parts(wanted, parts))):
            by = np.argsort(part, kind="stable")
            cut = np.searchsorted(part[by], np.arange(parts + 1, dtype=np.uint64))
            for k in range(parts):
                sel = by[cut[k]:cut[k + 1]]
                if len(sel):
                    rows.append((kind, chunk, k, None, None, pack_sorted(keys[sel]), pack(n[sel])))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _CHUNK)], schema=_CHUNK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size = TaskContext.get().partitionId() << 32, 0
        ids, held, texts = [], [], []
        for b in small_batches(batches, 2, 1 << 20):
            for i, h, t in zip(*(b.column(k).to_pylist() for k in range(3))):
                text = normal_bytes(t)
                if texts and size + len(text) > p.chunk_bytes:
                    yield rows_of(chunk, ids, held, texts)
                    chunk, size, ids, held, texts = chunk + 1, 0, [], [], []
                ids.append(i)
                held.append(int(h))
                texts.append(text)
                size += len(text)
        if texts:
            yield rows_of(chunk, ids, held, texts)

    return map_batches(docs, run, _CHUNK_DDL)


# -- parts --------------------------------------------------------------------

def add_lists(needs: DataFrame, buckets: int) -> DataFrame:
    """One list of distinct keys with their counts over all chunks for each kind and part.

    ``needs`` has a ``bucket`` below ``buckets``; buckets are added up as a tree.
    """
    schema = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("bucket", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        keys, at = np.unique(np.concatenate([unpack_sorted(x.as_py()) for x in table.column("keys")]), return_inverse=True)
        counts = np.concatenate([unpack(x.as_py(), np.int64) for x in table.column("counts")])
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, at, counts)
        first = [table.column(c)[0].as_py() for c in ("kind", "part", "bucket")]
        return pa.Table.from_pydict(dict(zip(schema.names, ([v] for v in (*first, pack_sorted(keys), pack(total))))), schema)

    lists = needs.select("kind", "part", "bucket", "keys", "counts")
    while True:
        lists = lists.groupBy("kind", "part", "bucket").applyInArrow(run, "kind int, part int, bucket bigint, keys binary, counts binary")
        if buckets == 1:
            return lists.drop("bucket")
        buckets = -(-buckets // FAN_IN)
        lists = lists.withColumn("bucket", F.pmod("bucket", F.lit(buckets)))


def part_summaries(totals: DataFrame, p: ContextParams) -> DataFrame:
    """(part, node, below, zeros, ones): shares of depth 2 nodes; node -1 has the distinct and all training tokens."""
    schema = pa.schema([("part", pa.int32()), ("node", pa.int64()), ("below", pa.float64()), ("zeros", pa.int64()), ("ones", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for kind, part, keys, counts in zip(*(b.column(k) for k in range(4))):
                part, keys, counts = part.as_py(), unpack_sorted(keys.as_py()), unpack(counts.as_py(), np.int64)
                if kind.as_py() == 2:
                    found = [-1], [float((counts > 0).sum())], [int(counts.sum())], [0]
                else:
                    t = Subtrees(keys, counts, p.depth)
                    below, zeros, ones = (np.bincount(t.up, v, len(t.second)) for v in (t.log_pw, t.zeros, t.ones))
                    found = t.second.astype(np.int64), below, zeros.astype(np.int64), ones.astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((np.full(len(found[0]), part), *found), schema)], schema=schema)

    return map_batches(totals.select("kind", "part", "keys", "counts"), run, "part int, node bigint, below double, zeros bigint, ones bigint")


def second_nodes(summaries: DataFrame, p: ContextParams) -> DataFrame:
    """(node, zeros, ones, log_pw, stay): depth 2 nodes over all parts."""
    added = summaries.where("node >= 0").groupBy("node").agg(*[F.sum(c).alias(c) for c in ("below", "zeros", "ones")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            below, zeros, ones = (b.column(k).to_numpy().astype(float) for k in (1, 2, 3))
            log_pw = weighted(zeros, ones, below) if p.depth > 2 else below
            stay = np.exp(log_kt(zeros, ones) - np.log(2) - log_pw)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), pa.array(log_pw), pa.array(stay)],
                                             names=["node", "zeros", "ones", "log_pw", "stay"])

    return map_batches(added, run, "node bigint, zeros bigint, ones bigint, log_pw double, stay double")


def part_models(totals: DataFrame, seconds: DataFrame, table: np.ndarray, p: ContextParams) -> DataFrame:
    """For each kind and part its keys with log10 probabilities of grams, or counts of words.

    ``seconds`` has for each part the depth 2 nodes above it.
    """
    schema = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("answers", pa.binary())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kind, packed, counts = (left.column(c)[0].as_py() for c in ("kind", "keys", "counts"))
        if kind == 1:
            keys = unpack_sorted(packed)
            t = Subtrees(keys, unpack(counts, np.int64), p.depth)
            mixed = t.ratios()
            if p.depth > 2:
                order = np.argsort(right.column("node").to_numpy())
                zeros, ones, stay = (right.column(c).to_numpy()[order] for c in ("zeros", "ones", "stay"))
                at = t.up[t.levels[-1][0]]
                z, o, stay = zeros[at], ones[at], stay[at]
                mixed = stay * (np.where(t.bit == 1, o, z) + 0.5) / (z + o + 1.0) + (1 - stay) * mixed
            near = (keys >> np.uint64(8 * p.depth)).astype(np.int64)[:, None]
            shallow = table[near, t.node.astype(np.int64)]
            known = np.where(t.bit == 1, shallow[..., 1], shallow[..., 0])
            counts = np.log10(known + shallow[..., 2] * mixed).sum(1).astype(np.float32).tobytes()
        return pa.Table.from_pydict({"kind": [kind], "part": [left.column("part")[0].as_py()], "keys": [packed], "answers": [counts]}, schema)

    return (totals.groupBy("kind", "part").cogroup(seconds.groupBy("kind", "part"))
            .applyInArrow(run, "kind int, part int, keys binary, answers binary"))


def part_answers(needs: DataFrame, models: DataFrame, buckets: int) -> DataFrame:
    """For each chunk and part: log10 probabilities of the chunk's grams, or counts of its words, in key order."""
    schema = pa.schema([("kind", pa.int32()), ("chunk", pa.int64()), ("part", pa.int32()), ("answers", pa.binary())])

    def run(rows: pa.Table, model: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return schema.empty_table()
        kind, keys, values = model.column("kind")[0].as_py(), unpack_sorted(model.column("keys")[0].as_py()), model.column("answers")[0].as_py()
        values, send = (np.frombuffer(values, np.float32), np.ndarray.tobytes) if kind == 1 else (unpack(values, np.int64), pack)
        answers = [send(values[np.searchsorted(keys, unpack_sorted(k.as_py()))]) for k in rows.column("keys")]
        return pa.Table.from_arrays([rows.column("kind"), rows.column("chunk"), rows.column("part"), pa.array(answers, pa.binary())], schema=schema)

    # A part's model goes to every bucket that may ask it.
    every = models.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))))
    by = ("kind", "part", "bucket")
    return (needs.select(*by, "chunk", "keys").groupBy(*by).cogroup(every.groupBy(*by))
            .applyInArrow(run, "kind int, chunk bigint, part int, answers binary"))


# -- scores -------------------------------------------------------------------

_SCORE_DDL = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
              "base_score double, score double, bits_per_byte double")


def chunk_scores(chunks: DataFrame, answers: DataFrame, p: ContextParams, parts: int, total: int, distinct: int) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("bits_per_byte", pa.float64())])

    def gather(rows: pa.Table, kind: int, part: np.ndarray, dtype) -> np.ndarray:
        out = np.zeros(len(part), dtype)
        for k, at, data in zip(rows.column("kind").to_pylist(), rows.column("part").to_pylist(), rows.column("answers")):
            if k == kind:
                out[part == at] = np.frombuffer(data.as_py(), np.float32) if kind == 1 else unpack(data.as_py(), np.int64)
        return out

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        import zstandard
        ids, held = left.column("ids")[0].as_py(), left.column("held")[0].as_py()
        payload = zstandard.ZstdDecompressor().decompress(left.column("keys")[0].as_py())
        grams, place, ends = gram_codes(payload, p.depth)
        order = np.argsort(grams)
        logs = np.empty(len(grams))
        logs[order] = gather(right, 1, gram_parts(grams[order], p.depth, parts), np.float64)
        lengths = np.diff(np.append(-1, ends))
        of_byte = np.repeat(np.arange(len(ids)), lengths)
        score = np.bincount(of_byte, logs[place], len(ids))
        hashes, wplace, of = word_codes(payload)
        wanted = _wanted_words(hashes, wplace)
        counts = gather(right, 2, word_parts(wanted, parts), np.int64)
        # The hash of an absent word stands for no place that is used.
        c = counts[np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)]
        end = counts[np.searchsorted(wanted, np.uint64(_end_hash()))]
        cost = lambda n: np.log10((n + 1) / (total + distinct + 1))
        base = np.bincount(of, cost(c)[wplace] if len(c) else None, len(ids)) + cost(end)
        known = np.bincount(of, (c > 0)[wplace] if len(c) else None, len(ids)).astype(np.int64) + int(end > 0)
        n = np.bincount(of, minlength=len(ids)) + 1
        return pa.Table.from_arrays([pa.array(ids, pa.int64()), pa.array(np.array(held) == 1), pa.array(n.astype(np.int64)), pa.array(known),
                                     pa.array(np.full(len(ids), total, np.int64)), pa.array(base), pa.array(score),
                                     pa.array(-score / np.log10(2) / lengths)], schema=schema)

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, _SCORE_DDL)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.pmod(id_hash(doc_id), F.lit(7)) == 2, F.lit(False))


def score_documents(docs: DataFrame, p: ContextParams = ContextParams()) -> DataFrame:
    """Scores of every document, from the model of those that are not held out."""
    spark = docs.sparkSession
    parts = p.parts or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ship_package(spark)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held"), "text")
    every = stored(chunked(given, p, parts), "chunks")
    buckets = max(1, -(-every.where("kind = 0").count() // p.bucket_chunks))
    needs = every.where("kind > 0").select("kind", "part", F.pmod(F.xxhash64("chunk"), F.lit(buckets)).alias("bucket"), "chunk", "keys", "counts")
    totals = stored(add_lists(needs, buckets), "totals")
    summaries = stored(part_summaries(totals, p), "summaries")
    seconds = stored(second_nodes(summaries, p), "seconds")
    words = summaries.where("node < 0").agg(F.sum("zeros"), F.sum("below")).first()
    first = F.shiftleft(F.shiftright("node", 16), 8).bitwiseOR(F.col("node").bitwiseAND(255))
    nodes = seconds.groupBy(first.alias("node")).agg(*[F.sum(c).alias(c) for c in ("log_pw", "zeros", "ones")]).orderBy("node").toPandas()
    table = shallow_table(nodes.node.to_numpy(np.int64), nodes.log_pw.to_numpy(float), nodes.zeros.to_numpy(float), nodes.ones.to_numpy(float))
    total, distinct = int(words[0] or 0), int(words[1] or 0)
    back = summaries.select(F.lit(1).alias("kind"), "part", "node").join(seconds.select("node", "zeros", "ones", "stay"), "node")
    answers = part_answers(needs, part_models(totals, back, table, p), buckets)
    return chunk_scores(every.where("kind = 0").select("chunk", "ids", "held", "keys"), answers, p, parts, total, distinct)
