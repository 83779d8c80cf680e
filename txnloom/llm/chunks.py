"""Encoding texts to ids chunk by chunk: a chunk is a word with the blank before it.

Both tokenizers of this folder never join characters across the blank that starts a chunk, so equal
chunks have equal ids. Distinct chunks of a batch are found in Arrow, encoded once, and their ids put
together in Arrow. A task keeps the ids of chunks in two generations of bounded bytes: when the younger is
full it replaces the older, and chunks that come again move to the younger. Long chunks are not kept, and
``forget`` empties both at the end of a task, as the worker process lives on.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks of more characters are encoded anew each time.
_LONGEST = 64


class ChunkEncoder:
    """``lead(chunks)`` encodes words with a blank before them, ``bare(texts)`` texts as they are.

    Both return one ``bytes`` of little-endian unsigned 32-bit ids per input. Texts in which ``mixed``
    is found go to ``bare`` as a whole.
    """

    def __init__(self, lead: Callable[[list[str]], list[bytes]], bare: Callable[[list[str]], list[bytes]],
                 lead_first: bool, mixed: re.Pattern, most_bytes: int = 32 << 20):
        self.lead, self.bare, self.lead_first, self.mixed, self.most_bytes = lead, bare, lead_first, mixed, most_bytes
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.bytes = 0

    def _keep(self, found: Iterable[tuple[str, bytes]]) -> None:
        kept = [(c, ids) for c, ids in found if len(c) <= _LONGEST]
        self.known.update(kept)
        # A key, a value and the dictionary's own entry.
        self.bytes += sum(len(c) + len(ids) + 180 for c, ids in kept)

    def _ids(self, chunks: list[str]) -> list[bytes]:
        if self.bytes > self.most_bytes:
            self.known, self.older, self.bytes = {}, self.known, 0
        known, older = self.known, self.older
        self._keep([(c, older[c]) for c in chunks if c in older and c not in known])
        new = [c for c in chunks if c not in known]
        if not new:
            return [known[c] for c in chunks]
        made = dict(zip(new, self.lead(new)))
        self._keep(made.items())
        return [made[c] if c in made else known[c] for c in chunks]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of every text; NULL and empty texts have none. Callers pass some megabytes at a time."""
        filled = pc.fill_null(texts, "")
        plain = filled.to_pylist()
        out: list[bytes] = [b""] * len(plain)
        whole = [i for i, t in enumerate(plain) if t and self.mixed.search(t)]
        for i, ids in zip(whole, self.bare([plain[i] for i in whole]) if whole else []):
            out[i] = ids
        odd = set(whole)
        rest = [i for i, t in enumerate(plain) if t and i not in odd]
        if not rest:
            return out
        lists = pc.split_pattern(filled.take(pa.array(rest)), " ")
        bounds = np.asarray(lists.offsets)
        coded = lists.flatten().dictionary_encode()
        ids = pa.array(self._ids(coded.dictionary.to_pylist()), pa.large_binary()).take(coded.indices)
        offsets = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1, ids.offset * 8)
        data = memoryview(ids.buffers()[2]) if ids.buffers()[2] else memoryview(b"")
        bounds = bounds - bounds[0]
        heads = None if self.lead_first else self.bare([plain[i].split(" ", 1)[0] for i in rest])
        for k, i in enumerate(rest):
            a, b = bounds[k], bounds[k + 1]
            if heads is None:
                out[i] = bytes(data[offsets[a]:offsets[b]])
            else:
                out[i] = heads[k] + bytes(data[offsets[a + 1]:offsets[b]])
        return out
