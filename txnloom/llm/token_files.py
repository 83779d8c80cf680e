"""Token ids on disk: each document compressed on its own with one shared dictionary.

A token folder holds three Parquet tables, all written by Spark's committers:

* ``dictionary``: one row with the zstandard dictionary, its sha256 and the bytes per id (2 or 4);
* ``shards``: one row per shard of some megabytes, in ascending doc_id order. ``body`` is the documents'
  zstandard frames one after the other; ``index`` has for each its id, the place of its first id within
  the part, its number of ids, and where its frame starts. ``dictionary_sha256`` names the dictionary;
* ``parts``: for each part of the sort, the number of ids before it.

A short document is read by opening one shard row, looking up the index and decompressing one frame.

Defined cases: a NULL or empty text is the end id alone. NULL doc_ids come first. Rows that share a doc_id
are separate documents, in the order of their checksums. A text that spells an added token of the tokenizer
file (``<|endoftext|>``) gets that token's id, as the file's own tokenizer gives it. Extra columns are ignored. An empty table gives
empty tables (and a dictionary row). The dictionary is trained on at most ``sample_docs`` short
documents (at most ``sample_ids`` bytes each), taken whole; where there are too few to train on, it is empty and frames are plain.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .chunks import ChunkEncoder
from .common import map_batches, scratch_path, small_batches, smallest_by_hash, stored

VOCABULARY = "byte_bpe_50k.json"
#: A run of white space in which a blank stands before more white space or the end.
_MIXED = re.compile(r"\s (?:\s|\Z)")
INDEX = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("start", "<i8"), ("n", "<u4"), ("at", "<u8")])


@dataclass(frozen=True)
class TokenParams:
    """The dictionary is trained on at most ``sample_docs`` documents of at most ``sample_ids`` bytes."""

    tokenizer: str = ""
    end_id: int = 2
    sample_docs: int = 2_000
    sample_ids: int = 8_000
    dictionary_bytes: int = 112_640
    shard_bytes: int = 4 << 20
    level: int = 3


def tokenizer_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


_ENCODERS: dict[str, ChunkEncoder] = {}


def byte_bpe_encoder(path: str) -> ChunkEncoder:
    """The encoder of a tokenizers file, one per worker process."""
    if path in _ENCODERS:
        return _ENCODERS[path]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    size = tok.get_vocab_size()
    begins = np.zeros(size, bool)
    begins[[i for t, i in tok.get_vocab().items() if t.startswith("Ġ")]] = True

    # Added tokens are found in the whole text before it is cut into words, so such texts are encoded whole.
    added = [t.content for t in tok.get_added_tokens_decoder().values()]
    mixed = re.compile("|".join([_MIXED.pattern, *map(re.escape, added)]))
    spaced = any(any(map(str.isspace, t)) for t in added)

    def bare(texts: list[str]) -> list[bytes]:
        got = tok.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in got]

    def lead(chunks: list[str]) -> list[bytes]:
        # Chunks without white space go through in one text; each starts at a token that starts with a blank.
        out: dict[str, bytes] = {}
        # Joined chunks could spell an added token that holds white space.
        easy = [] if spaced else [c for c in chunks if c and c.isprintable()]
        for k in range(0, len(easy), 2_000):
            part = easy[k:k + 2_000]
            ids = np.array(tok.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            cut = np.flatnonzero(begins[ids])
            if len(cut) != len(part):
                continue
            data, ends = ids.tobytes(), np.append(cut * 4, len(ids) * 4).tolist()
            out.update((c, data[a:b]) for c, a, b in zip(part, ends, ends[1:]))
        rest = [c for c in chunks if c not in out]
        out.update(zip(rest, bare([" " + c for c in rest])))
        return [out[c] for c in chunks]

    _ENCODERS[path] = ChunkEncoder(lead, bare, lead_first=False, mixed=mixed)
    return _ENCODERS[path]


def _wide(path: str) -> int:
    from tokenizers import Tokenizer
    return 2 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else 4


def _ids_of(texts: pa.Array, path: str, end_id: int) -> list[np.ndarray]:
    end = np.array([end_id], "<u4").tobytes()
    return [np.frombuffer(x + end, "<u4") for x in byte_bpe_encoder(path).encode(texts)]


def train_dictionary(docs: DataFrame, p: TokenParams, path: str, width: int) -> bytes:
    """A dictionary for serialized id arrays, from the whole arrays of a bounded sample of short documents."""
    import zstandard
    # Byte-level ids are at most as many as bytes, so short documents have whole arrays of a bounded length.
    short = docs.where("doc_id IS NOT NULL").where(F.octet_length("text") <= p.sample_ids)
    sample = smallest_by_hash(short.select("doc_id", "text"), "doc_id", p.sample_docs).repartition(8, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [x.astype(f"<u{width}").tobytes() for x in _ids_of(b.column(1), path, p.end_id)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.binary())], names=["doc_id", "ids"])

    rows = map_batches(sample, run, "doc_id bigint, ids binary").orderBy("doc_id", "ids").collect()
    ids = [bytes(r["ids"]) for r in rows]
    if len(ids) < 16 or sum(map(len, ids)) < 16 * 1024:
        return b""
    return zstandard.train_dictionary(min(p.dictionary_bytes, sum(map(len, ids)) // 8), ids).as_bytes()


def write_tokens(docs: DataFrame, folder: str, p: TokenParams = TokenParams()) -> None:
    """Encode every whole text and write the token folder."""
    spark = docs.sparkSession
    path = p.tokenizer or tokenizer_path()
    width = _wide(path)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dictionary = train_dictionary(docs, p, path, width)
    sha = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(sha, width, bytearray(dictionary))], "sha256 string, width int, dictionary binary").coalesce(1).write.mode(
        "overwrite").parquet(f"{folder}/dictionary")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        shared = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        pack = zstandard.ZstdCompressor(level=p.level, write_checksum=False, **shared)
        for b in small_batches(batches, 1, 4 << 20):
            ids = _ids_of(b.column(1), path, p.end_id)
            frames = [pack.compress(x.astype(f"<u{width}").tobytes()) for x in ids]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([len(x) for x in ids], pa.int64()),
                pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(frames, pa.binary())],
                names=["doc_id", "n", "crc", "frame"])

    # Stored once, so that the sampling for the sort does not encode everything a second time.
    frames = stored(map_batches(docs, encode, "doc_id bigint, n bigint, crc bigint, frame binary",
                                lambda: byte_bpe_encoder(path).forget()), "frames")
    ordered = (frames.withColumn("place", F.monotonically_increasing_id())
               .repartitionByRange(F.col("doc_id"), F.col("crc"), F.col("place"))
               .sortWithinPartitions("doc_id", "crc", "place"))

    def pack_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, start = TaskContext.get().partitionId(), 0, 0
        index, body, size = [], [], 0

        def shard():
            table = np.array(index, INDEX)
            return pa.RecordBatch.from_pydict({
                "part": [part], "seq": [seq], "first_id": [index[0][0] if index[0][1] else None],
                "last_id": [index[-1][0] if index[-1][1] else None], "n_docs": [len(index)],
                "n_ids": [int(table["n"].sum(dtype=np.int64))], "dictionary_sha256": [sha],
                "index": [table.tobytes()], "body": [b"".join(body)]}, _SHARD)

        for b in batches:
            for doc_id, n, frame in zip(*(b.column(k).to_pylist() for k in (0, 1, 3))):
                index.append((doc_id or 0, doc_id is not None, start, n, size))
                body.append(frame)
                start, size = start + n, size + len(frame)
                if size >= p.shard_bytes:
                    yield shard()
                    index, body, size, seq = [], [], 0, seq + 1
        if index:
            yield shard()

    map_batches(ordered, pack_shards, _SHARD_DDL).write.mode("overwrite").parquet(f"{folder}/shards")
    # One row per part of the sort: as many as the sort has tasks.
    totals = spark.read.parquet(f"{folder}/shards").groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    totals.select("part", F.coalesce(before, F.lit(0)).alias("before")).coalesce(1).write.mode("overwrite").parquet(f"{folder}/parts")


_SHARD_DDL = ("part int, seq int, first_id bigint, last_id bigint, n_docs int, n_ids bigint, "
              "dictionary_sha256 string, index binary, body binary")
_SHARD = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("first_id", pa.int64()), ("last_id", pa.int64()),
                    ("n_docs", pa.int32()), ("n_ids", pa.int64()), ("dictionary_sha256", pa.string()),
                    ("index", pa.binary()), ("body", pa.binary())])


def open_dictionary(spark: SparkSession, folder: str) -> tuple[str, int, bytes]:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    return row["sha256"], row["width"], bytes(row["dictionary"])


def _unpacker(dictionary: bytes):
    import zstandard
    return zstandard.ZstdDecompressor(**({"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}))


def _documents(index: bytes, body: bytes, unpack, width: int):
    table = np.frombuffer(index, INDEX)
    ends = np.append(table["at"][1:], len(body))
    for row, end in zip(table, ends):
        yield row, np.frombuffer(unpack.decompress(body[int(row["at"]):int(end)]), f"<u{width}").astype("<u4")


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """The documents of a token folder: doc_id, start, n_tokens, ids_crc32 and, if wanted, ids."""
    sha, width, dictionary = open_dictionary(spark, folder)
    shards = spark.read.parquet(f"{folder}/shards").select("part", "dictionary_sha256", "index", "body")
    ddl = "part int, doc_id bigint, place bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = _unpacker(dictionary)
        for b in batches:
            for part, named, index, body in zip(*(b.column(k).to_pylist() for k in range(4))):
                if named != sha:
                    raise ValueError(f"shard of dictionary {named}, folder has {sha}")
                rows = [(part, int(r["doc_id"]) if r["has_id"] else None, int(r["start"]), len(x), zlib.crc32(x),
                         *([x.astype("<i4")] if with_ids else [])) for r, x in _documents(index, body, unpack, width)]
                types = [pa.int32(), *[pa.int64()] * 4, *([pa.list_(pa.int32())] if with_ids else [])]
                names = [x.split()[0] for x in ddl.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    parts = spark.read.parquet(f"{folder}/parts")
    return (map_batches(shards, run, ddl).join(F.broadcast(parts), "part")
            .select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32",
                    *(["ids"] if with_ids else [])))


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[list[int]]:
    """Ids of the documents with this doc_id, decompressing nothing else."""
    _, width, dictionary = open_dictionary(spark, folder)
    unpack, found = _unpacker(dictionary), []
    held = spark.read.parquet(f"{folder}/shards").where(
        (F.coalesce("first_id", F.lit(-2 ** 63)) <= doc_id) & (F.col("last_id") >= doc_id)).orderBy("part", "seq")
    for shard in held.select("index", "body").toLocalIterator():
        table = np.frombuffer(bytes(shard["index"]), INDEX)
        ends = np.append(table["at"][1:], len(shard["body"]))
        for k in np.flatnonzero((table["doc_id"] == doc_id) & (table["has_id"] == 1)):
            frame = bytes(shard["body"][int(table["at"][k]):int(ends[k])])
            found.append(np.frombuffer(unpack.decompress(frame), f"<u{width}").tolist())
    return found


def token_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "tokens")
