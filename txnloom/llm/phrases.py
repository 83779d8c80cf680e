"""Phrase collocations by one FM-index per shard of word ids.

A task turns its texts into shards: the word ids of about ``shard_words`` words of one language, a
separator between pieces. A shard keeps the Burrows-Wheeler transform of its ids and of their reverse,
sorted by the first ``longest`` words, which is all that phrases of that length need. A phrase is a pair of
intervals, one in each transform; extending it by a word to the left or to the right updates both. Counts
are interval sizes, so a shard names each of its phrases once, and Spark adds the counts of all shards.

Phrases grow one word at a time, to the left and to the right in turn. A phrase can only reach ``least``
places if all phrases within it do. Rounds for phrases of one, two and three words add up counts by a 32-bit
hash; a hash whose sum stays below ``least`` rules out all its phrases. The other hashes reach the shards as
bits of a filter of at most ``filter_bits`` bits (32 MB). A last round names the phrases of all lengths that
the filters leave, and adds up their exact counts. A hash or bit shared by chance only lets a phrase through
that the exact sum removes, so results never depend on the size of the filter.

Joins take the counts of the parts of every cut and of the left and right extensions. No task holds more
than a shard, which is at least one piece (a stretch of text without ``.,;:!?`` or line end).

Defined cases: NULL texts are empty, NULL languages are ``und``; repeated rows count each time; ties go to
the smaller cut and the smaller phrase in byte order; an empty table gives no rows; other columns than
language and text are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, small_batches, stored

_MAP = bytearray(range(256))
for _b in b".,;:!?\x0a\x0b\x0c\x0d":
    _MAP[_b] = 10
_MAP[9] = 32
_MAP = bytes(_MAP)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SHARD = "lang string, n_words long, words array<string>, before binary, after binary"


@dataclass(frozen=True)
class PhraseParams:
    least: int = 100
    longest: int = 5
    top: int = 2_000
    shard_words: int = 1 << 18
    filter_bits: int = 1 << 28


# -- word ids -----------------------------------------------------------------

def piece_words(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """Distinct words and, for all texts in a row, word numbers from 1; 0 ends every piece that has words."""
    flat = pa.array([t.encode("utf-8", "surrogatepass").lower().translate(_MAP).replace(b"\n", b" \n ") + b" \n" for t in texts],
                    pa.large_binary())
    coded = pc.split_pattern(flat, b" ").flatten().dictionary_encode()
    words, number = [], np.zeros(len(coded.dictionary), np.int64)
    for i, w in enumerate(coded.dictionary.to_pylist()):
        if w == b"":
            number[i] = -1
        elif w != b"\n":
            words.append(w)
            number[i] = len(words)
    ids = number[coded.indices.to_numpy()]
    ids = ids[ids >= 0]
    return words, ids[(ids > 0) | (np.concatenate(([0], ids[:-1])) > 0)]


class _Gatherer:
    """The ids of one language until they fill a shard."""

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, words: list[bytes], ids: np.ndarray) -> None:
        known = self.known
        here = np.zeros(len(words) + 1, np.int64)
        for i, w in enumerate(words, 1):
            here[i] = known.setdefault(w, len(known) + 1)
        self.parts.append(here[ids].astype(np.int32))
        self.size += len(ids)


# -- the index of a shard -----------------------------------------------------

def _stable_order(key: np.ndarray, top: int) -> np.ndarray:
    """Places sorted by keys of at most ``top``, equal ones by place."""
    shift = max(1, (len(key) - 1).bit_length())
    if top.bit_length() + shift > 62:
        return np.argsort(key, kind="stable")
    return np.sort((key.astype(np.int64) << shift) | np.arange(len(key))) & ((1 << shift) - 1)


def _context_order(ids: np.ndarray, depth: int) -> np.ndarray:
    """Places sorted by the ``depth`` ids from there on (0 after the end), equal ones by place."""
    n, have = len(ids), 1
    rank = ids = ids.astype(np.int64)
    order = _stable_order(rank, int(rank.max(initial=0)))
    while have < depth:
        follow, step = (rank, have) if 2 * have <= depth else (ids, 1)
        wide = int(follow.max(initial=0)) + 1
        shifted = np.zeros(n, np.int64)
        shifted[:max(n - have, 0)] = follow[have:]
        key = rank * wide + shifted
        order = _stable_order(key, (int(rank.max(initial=0)) + 1) * wide)
        key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([1], 1 + np.cumsum(key[1:] != key[:-1])))
        have += step
    return order


def transform(ids: np.ndarray, depth: int) -> np.ndarray:
    """The id before each place, places in context order; the first place follows a separator."""
    return np.concatenate(([0], ids[:-1]))[_context_order(ids, depth)].astype(_width(int(ids.max(initial=0))))


def _width(n_words: int) -> str:
    return "<u2" if n_words < 1 << 16 else "<u4"


@dataclass
class Grams:
    """Phrases of one length with their intervals: rows ``lo`` in ``before``, rows ``mirror`` in ``after``."""
    ids: np.ndarray
    lo: np.ndarray
    mirror: np.ndarray
    count: np.ndarray

    def where(self, keep: np.ndarray) -> Grams:
        return Grams(self.ids[keep], self.lo[keep], self.mirror[keep], self.count[keep])


class ShardIndex:
    """Bidirectional interval extension over the two transforms of a shard."""

    def __init__(self, before: np.ndarray, after: np.ndarray, n_words: int):
        self.n_words = n_words
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(before, minlength=n_words + 1))))
        self.sides = (before, after)
        self.maps: list[np.ndarray | None] = [None, None]

    def _map(self, side: int) -> np.ndarray:
        """Row of the suffix that is one id longer, for each row."""
        if self.maps[side] is None:
            there = np.empty(len(self.sides[side]), np.int64)
            there[_stable_order(self.sides[side], self.n_words)] = np.arange(len(there))
            self.maps[side] = there
        return self.maps[side]

    def single(self) -> Grams:
        lo = self.starts[1:-1]
        return Grams(np.arange(1, self.n_words + 1)[:, None], lo, lo, np.diff(self.starts)[1:])

    def extend(self, grams: Grams, left: bool) -> Grams:
        """All phrases one word longer on that side, with their counts."""
        side = 0 if left else 1
        here, there = (grams.lo, grams.mirror) if left else (grams.mirror, grams.lo)
        begin = np.cumsum(grams.count) - grams.count
        parent = np.repeat(np.arange(len(here)), grams.count)
        rows = np.arange(len(parent)) + (here - begin)[parent]
        key = parent * (self.n_words + 1) + self.sides[side][rows]
        order = _stable_order(key, len(here) * (self.n_words + 1))
        key = key[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.concatenate((first, [len(key)])))
        parent, word = np.divmod(key[first], self.n_words + 1)
        longer_here = self._map(side)[rows[order[first]]] if len(first) else first
        longer_there = there[parent] + first - begin[parent]  # rows of smaller ids come first in the other transform
        ids = [word[:, None], grams.ids[parent]]
        ids = np.concatenate(ids if left else ids[::-1], axis=1)
        lo, mirror = (longer_here, longer_there) if left else (longer_there, longer_here)
        return Grams(ids, lo, mirror, size).where(word > 0)


# -- hashes for the filter ----------------------------------------------------

def _word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def _buckets(hashes: np.ndarray, lang: str) -> np.ndarray:
    """A number of 32 bits per row of word hashes."""
    with np.errstate(over="ignore"):
        h = np.full(len(hashes), _word_hash(lang.encode("utf-8", "surrogatepass")), np.uint64)
        for k in range(hashes.shape[1]):
            h = (h ^ (h >> np.uint64(29))) * _STEP + hashes[:, k]
        h = (h ^ (h >> np.uint64(32))) * _STEP
    return (h >> np.uint64(32)).astype(np.int64)


def _has(filled: np.ndarray, hashes: np.ndarray, lang: str) -> np.ndarray:
    at = _buckets(hashes, lang) & (len(filled) * 8 - 1)
    return (filled[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def bucket_filter(buckets: DataFrame, p: PhraseParams) -> np.ndarray:
    """The filter of a table of buckets: bitmaps built in Spark, at most ``filter_bits`` bits in all."""
    bits = 1 << 15
    wanted = 32 * buckets.count()
    while bits < min(wanted, p.filter_bits):
        bits *= 2
    at = F.col("bucket").bitwiseAND(F.lit(bits - 1)) + 1
    maps = (buckets.groupBy(F.bitmap_bucket_number(at).alias("part"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("map")))
    filled = np.zeros(bits // 8, np.uint8)
    for part, found in maps.collect():  # at most filter_bits / 32768 rows of 4 KB
        filled[(part - 1) * 4096:part * 4096] = np.frombuffer(found, np.uint8)
    return filled


# -- Spark --------------------------------------------------------------------

def build_shards(docs: DataFrame, p: PhraseParams = PhraseParams()) -> DataFrame:
    """One row per shard: its words with counts and the two transforms."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where(F.col("text").isNotNull())

    def shard(lang: str, got: _Gatherer) -> pa.RecordBatch:
        ids = np.concatenate([[0], *got.parts]).astype(np.int32)
        words = [w.decode("utf-8", "surrogatepass") for w in got.known]
        columns = [[lang], [int(np.count_nonzero(ids))], [words], [transform(ids, p.longest).tobytes()],
                   [transform(ids[::-1], p.longest).tobytes()]]
        types = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                          names=["lang", "n_words", "words", "before", "after"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Gatherer] = {}
        for batch in small_batches(batches, 1, 4 << 20):
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, group in by_lang.items():
                held.setdefault(lang, _Gatherer()).add(*piece_words(group))
            # However many languages there are, a task holds a shard's worth of ids in all.
            while sum(g.size for g in held.values()) >= p.shard_words:
                lang = max(held, key=lambda k: held[k].size)
                yield shard(lang, held.pop(lang))
        for lang, got in held.items():
            yield shard(lang, got)

    return map_batches(texts, run, _SHARD)


def _grown(index: ShardIndex, hashes: np.ndarray, lang: str, filters: list[np.ndarray], longest: int) -> Iterator[Grams]:
    """The shard's phrases of 1 to ``longest`` words whose parts all pass the filters for their length."""
    grams = index.single()
    for n in range(1, longest + 1):
        if n <= len(filters):
            grams = grams.where(_has(filters[n - 1], hashes[grams.ids], lang))
        yield grams
        if n < longest:
            grams = index.extend(grams, left := n % 2 == 1)
            # The part at the end that grew; all other parts lie in the phrase it grew from.
            k = min(n, len(filters))
            part = grams.ids[:, :k] if left else grams.ids[:, n + 1 - k:]
            grams = grams.where(_has(filters[k - 1], hashes[part], lang))


def _read_shard(batch: pa.RecordBatch, i: int) -> tuple[str, pa.Array, ShardIndex, np.ndarray]:
    lang, words = batch.column(0)[i].as_py(), batch.column(1)[i].values
    hashes = np.array([0, *(_word_hash(w.encode("utf-8", "surrogatepass")) for w in words.to_pylist())], np.uint64)
    before, after = (np.frombuffer(batch.column(k)[i].as_buffer(), _width(len(words))) for k in (2, 3))
    return lang, words, ShardIndex(before, after, len(words)), hashes


def heavy_buckets(shards: DataFrame, length: int, filters: list[np.ndarray], p: PhraseParams) -> DataFrame:
    """(bucket) of the buckets that hold at least ``least`` places of phrases of that length."""
    held = shards.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lang, _, index, hashes = _read_shard(batch, i)
                *_, grams = _grown(index, hashes, lang, held.value, length)
                for start in range(0, len(grams.count), 100_000):
                    part = grams.where(slice(start, start + 100_000))
                    yield pa.RecordBatch.from_arrays([pa.array(_buckets(hashes[part.ids], lang)), pa.array(part.count, pa.int64())],
                                                     names=["bucket", "f"])

    found = map_batches(shards.select("lang", "words", "before", "after"), run, "bucket long, f long")
    return found.groupBy("bucket").agg(F.sum("f").alias("f")).where(F.col("f") >= p.least).select("bucket")


def phrase_counts(shards: DataFrame, filters: list[np.ndarray], p: PhraseParams) -> DataFrame:
    """(lang, phrase, size, f) of all phrases that occur at least ``least`` times."""
    held = shards.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lang, words, index, hashes = _read_shard(batch, i)
                for size, grams in enumerate(_grown(index, hashes, lang, held.value, p.longest), 1):
                    for start in range(0, len(grams.count), 50_000):
                        part = grams.where(slice(start, start + 50_000))
                        texts = [words.take(pa.array(part.ids[:, k] - 1)) for k in range(size)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(part.count), pa.string()),
                             pc.binary_join_element_wise(*texts, " ") if size > 1 else texts[0],
                             pa.array([size] * len(part.count), pa.int32()), pa.array(part.count, pa.int64())],
                            names=["lang", "phrase", "size", "f"])

    found = map_batches(shards.select("lang", "words", "before", "after"), run, "lang string, phrase string, size int, f long")
    return found.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).where(F.col("f") >= p.least)


def frequent_phrases(docs: DataFrame, p: PhraseParams = PhraseParams()) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of all phrases of 1 to ``longest`` words, and (lang, n) of all languages."""
    shards = stored(build_shards(docs, p), "phrase-shards")
    filters: list[np.ndarray] = []
    for length in range(1, min(3, p.longest) + 1):
        filters.append(bucket_filter(stored(heavy_buckets(shards, length, filters, p), f"phrase-buckets-{length}"), p))
    return stored(phrase_counts(shards, filters, p), "phrases"), shards.groupBy("lang").agg(F.sum("n_words").alias("n"))


def cut_score(a: str, n: str, l: str, r: str):
    """floor(1000 * a * n / (l * r)) in whole numbers of up to 38 digits."""
    big = {k: f"CAST({v} AS DECIMAL(19, 0))" for k, v in {"a": a, "n": n, "l": l, "r": r}.items()}
    return F.expr("CAST(CAST({a} * {n} AS DECIMAL(35, 0)) * 1000BD AS DECIMAL(38, 0)) div CAST({l} * {r} AS DECIMAL(38, 0))".format(**big))


def collocations(docs: DataFrame, p: PhraseParams = PhraseParams()) -> DataFrame:
    """The first ``top`` phrases of every language by the score of their weakest cut."""
    phrases, totals = frequent_phrases(docs, p)
    longer = phrases.where("size > 1")
    words = F.split("phrase", " ")

    def joined(start, size):
        return F.array_join(F.slice(words, start, size), " ")

    parts = phrases.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    cuts = (longer.select("lang", "phrase", "f", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), "size")
            .select("lang", "phrase", "f", "k", joined(F.lit(1), F.col("k")).alias("first"),
                    joined(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest")))
    scored = (cuts.join(parts.select("lang", F.col("part").alias("first"), F.col("part_f").alias("l")), ["lang", "first"])
              .join(parts.select("lang", F.col("part").alias("rest"), F.col("part_f").alias("r")), ["lang", "rest"])
              .join(totals, "lang")
              .withColumn("score", cut_score("f", "n", "l", "r"))
              .groupBy("lang", "phrase", "f", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    # A longer phrase with as many places has one of one more word with as many, to the left or right.
    ends = longer.where("size > 2").select("lang", "f", F.explode(F.array(
        joined(F.lit(1), F.col("size") - 1), joined(F.lit(2), F.col("size") - 1))).alias("phrase"))
    extended = ends.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    closed = (scored.join(extended, ["lang", "phrase"], "left")
              .where(F.col("most").isNull() | (F.col("most") < F.col("f"))))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("f"), "phrase")
    return (closed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= p.top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("f").alias("a"),
                    "cut.l", "cut.r", "n", "cut.score"))
