"""SentencePiece encoding and decoding by a streaming Viterbi search.

The best segmentation has the largest sum of piece scores; a character that no piece covers becomes its
UTF-8 byte pieces, at a score below every piece. ``StreamingViterbi`` reads characters one after the
other; only paths that end within the longest piece from its end still live. Whenever the backpointers of
all live paths meet in one boundary, the ids before it are final and leave the window. In ordinary text that
is every few words. In a long run of one sign (dashes, blanks) paths of different remainders need never meet;
then scores and backpointers of the run are kept, some 200 bytes a character, and the time stays linear.

No piece has a blank mark behind another character, so all paths meet where a run of marks starts; equal
words are thus encoded once per worker and batch.

Defined cases: NULL and empty texts have no ids. A text's own U+2581 is decoded as a blank, as in the
format itself; ``round_trip`` tells where decoding does not give the text back. Ties keep the longer
last piece. Long texts and long words are streamed, never cut. Repeated rows, NULL ids and extra columns
pass through; columns named like a result are replaced. Vocabularies are never trained here.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ship_package
from .chunks import ChunkEncoder
from .common import releasing, small_batches

MARK = "▁"
MODEL = "piece_bpe_32k.model"
#: Marks and what follows them up to the next mark; texts in which marks may touch.
_RUNS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_MIXED = re.compile(f"  |{MARK}|\\A ")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Pieces:
    """The vocabulary: a trie of scored pieces, byte pieces, and the text of every id."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        texts = [sp.id_to_piece(i) for i in range(self.size)]
        plain = [i for i in range(self.size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        score = {texts[i]: sp.get_score(i) for i in plain}
        self.bytes = {int(texts[i][3:5], 16): i for i in range(self.size) if sp.is_byte(i)}
        self.unknown = next((i for i in range(self.size) if sp.is_unknown(i)), 0)
        self.low = min(score.values()) - 10.0
        self.trie: dict = {}
        self.longest = 1
        if any(MARK in texts[i].lstrip(MARK) for i in plain):
            raise ValueError("a piece joins two words; texts cannot be encoded word by word")
        for i in plain:
            node = self.trie
            for ch in texts[i]:
                node = node.setdefault(ch, {})
            node[""] = (score[texts[i]], i)
            self.longest = max(self.longest, len(texts[i]))
        self.output = [bytes([int(t[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i)
                       else t.replace(MARK, " ").encode() for i, t in enumerate(texts)]

    def fallback(self, ch: str) -> list[int]:
        data = ch.encode("utf-8", "surrogatepass")
        return [self.bytes[b] for b in data] if all(b in self.bytes for b in data) else [self.unknown]


class StreamingViterbi:
    """Feed characters, collect ids; ``finish`` returns the rest."""

    def __init__(self, pieces: Pieces, check_every: int = 64):
        self.p, self.check = pieces, max(check_every, pieces.longest)
        self.text, self.ids = "", []
        self.score: list[float] = [0.0]
        self.back: list[tuple[int, int]] = [(0, -1)]  # start of the last piece, its id or -1 for bytes
        self.done = 0  # positions whose outgoing pieces are known

    def feed(self, text: str) -> list[int]:
        """Take more text and return the ids that it makes final."""
        at = 0
        while at < len(text):
            # Where paths do not meet, what is kept grows; looking for a meeting point each time that it has
            # grown by half keeps the work linear.
            size = max(self.check, len(self.text) // 2)
            self.text += text[at:at + size]
            at += size
            self._advance(len(self.text) - self.p.longest)
            self._commit()
        out, self.ids = self.ids, []
        return out

    def finish(self) -> list[int]:
        self._advance(len(self.text))
        self._emit(len(self.text))
        out, self.ids = self.ids, []
        return out

    def _advance(self, upto: int) -> None:
        text, score, back, trie, low = self.text, self.score, self.back, self.p.trie, self.p.low
        n = len(text)
        for i in range(self.done, upto):
            here, node, single = score[i], trie, False
            j = i
            while j < n:
                node = node.get(text[j])
                if node is None:
                    break
                j += 1
                piece = node.get("")
                if piece is not None:
                    single |= j == i + 1
                    self._offer(j, here + piece[0], i, piece[1])
            if not single:
                self._offer(i + 1, here + low, i, -1)
        self.done = max(self.done, upto)

    def _offer(self, at: int, value: float, start: int, piece: int) -> None:
        score, back = self.score, self.back
        while len(score) <= at:
            score.append(-float("inf"))
            back.append((0, -1))
        if value > score[at]:
            score[at], back[at] = value, (start, piece)

    def _commit(self) -> None:
        """Cut at the last boundary on which all live paths meet."""
        live = set(range(max(self.done, 1), len(self.score)))
        if not live:
            return
        while len(live) > 1:
            last = max(live)
            live.discard(last)
            live.add(self.back[last][0])
        cut = live.pop()
        if 0 < cut <= self.done:
            self._emit(cut)
            base = self.score[cut]
            self.text = self.text[cut:]
            self.score = [s - base for s in self.score[cut:]]
            self.back = [(0, -1)] + [(a - cut, b) for a, b in self.back[cut + 1:]]
            self.done -= cut

    def _emit(self, at: int) -> None:
        found = []
        while at > 0:
            start, piece = self.back[at]
            found.append([piece] if piece >= 0 else self.p.fallback(self.text[start:at]))
            at = start
        for ids in reversed(found):
            self.ids += ids


def encode_stream(pieces: Pieces, text: str) -> list[int]:
    search = StreamingViterbi(pieces)
    return search.feed(text) + search.finish()


_LOADED: dict[str, tuple[Pieces, ChunkEncoder]] = {}


def piece_encoder(path: str) -> tuple[Pieces, ChunkEncoder]:
    """Vocabulary and encoder, one per worker process."""
    if path not in _LOADED:
        pieces = Pieces(path)

        def lead(chunks: list[str]) -> list[bytes]:
            return [np.array(encode_stream(pieces, MARK + c), "<u4").tobytes() for c in chunks]

        def bare(texts: list[str]) -> list[bytes]:
            known: dict[str, bytes] = {}
            out = []
            for t in texts:
                runs = _RUNS.findall(MARK + t.replace(" ", MARK))
                known.update((r, np.array(encode_stream(pieces, r), "<u4").tobytes()) for r in set(runs) - known.keys())
                out.append(b"".join([known[r] for r in runs]))
            return out

        _LOADED[path] = pieces, ChunkEncoder(lead, bare, lead_first=True, mixed=_MIXED)
    return _LOADED[path]


def decode(pieces: Pieces, ids) -> str:
    """Text of ids; the blank put before the first word goes."""
    text = b"".join([pieces.output[i] for i in ids]).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def encode_pieces(docs: DataFrame, path: str = "", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Kept columns with ``n_pieces``, ``ids``, ``ids_crc32`` and whether decoding gives the text back."""
    path = path or model_path()
    added = {"n_pieces", "ids", "ids_crc32", "round_trip"}
    kept = [c for c in keep if c.lower() not in added]
    held = docs.select(*[F.col(f"`{c}`") for c in kept], F.col("text").alias("_text_in"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, encoder = piece_encoder(path)
        output = pa.array(pieces.output, pa.large_binary())
        for b in small_batches(batches, len(kept)):
            texts = b.column(len(kept))
            coded = encoder.encode(texts)
            lengths = np.array([len(x) // 4 for x in coded], np.int64)
            ids = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
            ends = np.append(0, np.cumsum(lengths))
            back = output.take(pa.array(ids))
            at = np.frombuffer(back.buffers()[1], np.int64, len(back) + 1, back.offset * 8)[ends] if len(back) else ends * 0
            data = memoryview(back.buffers()[2]) if len(back) and back.buffers()[2] else memoryview(b"")
            same = [bytes(data[at[k]:at[k + 1]])[1:] == t.encode("utf-8", "surrogatepass") if t else True
                    for k, t in enumerate(texts.to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(kept)], pa.array(lengths), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                 pa.array([zlib.crc32(x) for x in coded], pa.int64()), pa.array(same, pa.bool_())],
                names=[*kept, "n_pieces", "ids", "ids_crc32", "round_trip"])

    ship_package(docs.sparkSession)
    new = StructType.fromDDL("n_pieces bigint, ids array<int>, ids_crc32 bigint, round_trip boolean")
    schema = StructType(held.drop("_text_in").schema.fields + new.fields)
    return held.mapInArrow(releasing(run, lambda: piece_encoder(path)[1].forget()), schema)


def decode_pieces(rows: DataFrame, path: str = "") -> DataFrame:
    """Rows with the ``text`` of their ``ids``; NULL for NULL ids."""
    from .common import with_columns_of
    path = path or model_path()
    return with_columns_of(rows, lambda lists: [[None if x is None else decode(piece_encoder(path)[0], x) for x in lists]],
                           "text string", source="ids")
