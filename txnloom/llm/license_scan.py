"""Licence scan by a generalised suffix automaton of licence words.

One automaton holds all phrases and templates. A text streams through it in blocks of ``block`` characters:
the automaton gives, at every word, the longest run of words ending there that occurs in any template (the
matching statistics), in amortised constant time, and its state goes on from block to block. Words that no
template has only reset it, so stretches without two known words in a row are passed over in numpy.

- A phrase stands wherever the run has at least its length and its state lies below the phrase's.
- A match of at least ``least`` words with a place of a template ends where the next word no longer goes on
  in that template. The matches of a template are chained in the order of both, gaps of at most ``gap``
  words apart; the share of the template's words that a chain covers decides whether its span counts.

``score`` is the largest share of a template that any chain covers, 1 where a phrase stands. The work is a
single pass without a shuffle; templates are a small fixed table that travels with the task.

Defined cases: NULL and empty texts have no words, no labels, NULL places and score 0; texts of any length
stream through in blocks; repeated rows get equal results; other columns stay (those named like a new one
are replaced); an empty table stays empty. Overlapping spans of one template: the larger share stays, then
the earlier one.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_columns_of
from .license_texts import BASE_PHRASES, OWN_PHRASES, TEMPLATES

_MAP = bytes(32 if b < 0x30 or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F
             else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


@dataclass(frozen=True)
class ScanParams:
    least: int = 4
    gap: int = 12
    share: float = 0.6
    block: int = 1 << 20


def license_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_MAP).split()


class SuffixAutomaton:
    """All runs of words of several sequences, each run in the state of the places where it ends."""

    def __init__(self, sequences: Iterable[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.sequences = [list(s) for s in sequences]
        own: list[list[tuple[int, int]]] = [[]]
        self.whole: list[int] = []
        for t, words in enumerate(self.sequences):
            state = 0
            for at, word in enumerate(words):
                state = self._append(state, word)
                own += [[] for _ in range(len(self.next) - len(own))]
                own[state].append((t, at))
            self.whole.append(state)
        #: (sequence, place of the last word) of everything that ends in a state, longest states first.
        self.ends = own
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                own[self.link[state]].extend(own[state])

    def _state(self, length: int, link: int, arcs: dict[int, int]) -> int:
        self.next.append(arcs)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A state of its own for the runs of ``target`` that are not longer than ``state`` and the word."""
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _append(self, state: int, word: int) -> int:
        target = self.next[state].get(word)
        if target is not None:
            return target if self.length[target] == self.length[state] + 1 else self._split(state, word, target)
        made = self._state(self.length[state] + 1, 0, {})
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = made
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            self.link[made] = target if self.length[target] == self.length[state] + 1 else self._split(state, word, target)
        return made

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        """State and length of the longest known run that ends with the word."""
        while state and word not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        target = self.next[state].get(word)
        return (0, 0) if target is None else (target, length + 1)


@dataclass
class Scan:
    """What a text holds: phrases as (phrase, first word), matches as (template, first word, place, words)."""
    n_words: int
    phrases: list[tuple[int, int]]
    matches: list[tuple[int, int, int, int]]


class LicenseScanner:
    """Phrases and templates in one automaton."""

    def __init__(self, phrases: dict[str, str], templates: Iterable[tuple[str, str, str]], p: ScanParams = ScanParams()):
        self.p = p
        self.phrase_labels = list(phrases.values())
        self.names = [n for n, _, _ in templates]
        self.labels = [label for _, label, _ in templates]
        texts = [license_words(x) for x in phrases] + [license_words(x) for _, _, x in templates]
        self.ids: dict[bytes, int] = {}
        sequences = [[self.ids.setdefault(w, len(self.ids)) for w in words] for words in texts]
        self.longest_word = max(map(len, self.ids), default=0)
        self.automaton = a = SuffixAutomaton(sequences)
        self.sizes = [len(s) for s in sequences[len(phrases):]]
        self.first_template = len(phrases)
        self.shortest = min([p.least, *(len(s) for s in sequences[:len(phrases)])])
        #: Phrases that end where a state ends, with their lengths.
        self.said: list[list[tuple[int, int]]] = [[] for _ in a.next]
        for state in sorted(range(1, len(a.next)), key=a.length.__getitem__):
            self.said[state] = [(k, len(sequences[k])) for k in range(len(phrases)) if a.whole[k] == state] + self.said[max(a.link[state], 0)]
        self._long: dict[int, list[tuple[int, int, int]]] = {}

    def _places(self, state: int) -> list[tuple[int, int, int]]:
        """(template, place of its last word, longest common run) of all places sharing ``least`` words with the state."""
        if state not in self._long:
            a, found, at = self.automaton, {}, state
            while at > 0 and a.length[at] >= self.p.least:
                for t, end in a.ends[at]:
                    if t >= self.first_template:
                        found.setdefault((t - self.first_template, end), a.length[at])
                at = a.link[at]
            self._long[state] = [(t, end, n) for (t, end), n in found.items()]
        return self._long[state]

    def _blocks(self, text: str) -> Iterable[list[bytes]]:
        """Words of the text, some at a time; a word on the edge of two blocks comes once."""
        held = b""
        for start in range(0, len(text), self.p.block):
            data = held + text[start:start + self.p.block].encode("utf-8", "surrogatepass").translate(_MAP)
            words = data.split()
            # Words hold no byte below 0x30, so a last byte of 32 ends a word.
            held = words.pop()[:self.longest_word + 1] if words and data[-1] != 32 else b""
            yield words
        if held:
            yield [held]

    def scan(self, text: str | None) -> Scan:
        a, out, base = self.automaton, Scan(0, [], []), 0
        state = length = 0
        get = self.ids.get
        for words in self._blocks(text or ""):
            ids = np.fromiter((get(w, -1) for w in words), np.int32, len(words))
            known = np.concatenate(([0], ids >= 0, [0])).astype(np.int8)
            edge = np.diff(known)
            starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            keep = (stops - starts >= self.shortest) | (starts == 0) | (stops == len(words))
            at = 0
            for start, stop in zip(starts[keep].tolist(), stops[keep].tolist()):
                if start > at:
                    self._close(out, state, length, base + at, -1)
                    state = length = 0
                for i in range(start, stop):
                    word = int(ids[i])
                    if length >= self.p.least:
                        self._close(out, state, length, base + i, word)
                    state, length = a.step(state, length, word)
                    for k, n in self.said[state]:
                        if length >= n:
                            out.phrases.append((k, base + i + 1 - n))
                at = stop
            if at < len(words):
                self._close(out, state, length, base + at, -1)
                state = length = 0
            base += len(words)
        self._close(out, state, length, base, -1)
        out.n_words = base
        return out

    def _close(self, out: Scan, state: int, length: int, after: int, word: int) -> None:
        """Name the matches that end before word number ``after``, as that word does not go on in their template."""
        if length < self.p.least:
            return
        for t, end, common in self._places(state):
            words = self.automaton.sequences[self.first_template + t]
            if end + 1 == len(words) or words[end + 1] != word:
                n = min(length, common)
                out.matches.append((t, after - n, end + 1 - n, n))

    def spans(self, matches: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
        """Best chains as (template, first word, word after the last, covered words)."""
        out = []
        for t in sorted({m[0] for m in matches}):
            mine = sorted((s + n, s, place, n) for k, s, place, n in matches if k == t)
            ends = [m[0] for m in mine]
            best: list[tuple[int, int]] = []  # words covered by the best chain that ends with a match, its first word
            for j, (stop, start, place, n) in enumerate(mine):
                covered, first = n, start
                for i in range(bisect_left(ends, start - self.p.gap, 0, j), j):
                    before, start_i, place_i, n_i = mine[i]
                    more = min(n, place + n - place_i - n_i, stop - before)
                    if more > 0 and start_i < start and place_i < place and (best[i][0] + more, -best[i][1]) > (covered, -first):
                        covered, first = best[i][0] + more, best[i][1]
                best.append((covered, first))
            taken: list[tuple[int, int]] = []
            for covered, first, stop in sorted(((c, f, m[0]) for (c, f), m in zip(best, mine)), key=lambda x: (-x[0], x[1], x[2])):
                at = bisect_left(taken, (first, stop))
                if (at == 0 or taken[at - 1][1] <= first) and (at == len(taken) or taken[at][0] >= stop):
                    taken.insert(at, (first, stop))
                    out.append((t, first, stop, covered))
        return sorted(out, key=lambda x: (x[1], x[2], x[0]))


_COLUMNS = ("n_words bigint, phrases array<struct<label:string,first_word:bigint>>, "
            "spans array<struct<template:string,label:string,first_word:bigint,last_word:bigint,share:double>>, score double")


def scan_licenses(docs: DataFrame, keep: tuple[str, ...] | None = None, phrases: dict[str, str] | None = None,
                  templates: Iterable[tuple[str, str, str]] = TEMPLATES, p: ScanParams = ScanParams()) -> DataFrame:
    """Kept columns with word count, places of phrases, template spans and the largest share of a template."""
    scanner = LicenseScanner(BASE_PHRASES | OWN_PHRASES if phrases is None else phrases, tuple(templates), p)

    def make(texts: list[str | None]) -> list[list]:
        rows = []
        for text in texts:
            got = scanner.scan(text)
            chains = scanner.spans(got.matches) if got.matches else []
            shares = [c / scanner.sizes[t] for t, _, _, c in chains]
            rows.append((got.n_words, [{"label": scanner.phrase_labels[k], "first_word": at} for k, at in got.phrases],
                         [{"template": scanner.names[t], "label": scanner.labels[t], "first_word": a, "last_word": b - 1, "share": s}
                          for (t, a, b, _), s in zip(chains, shares) if s >= p.share],
                         1.0 if got.phrases else max(shares, default=0.0)))
        return [list(c) for c in zip(*rows)] if rows else [[], [], [], []]

    return with_columns_of(docs, make, _COLUMNS, keep=keep)


def license_report(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: places of the base phrases, and labels by phrases and spans."""
    # One scan finds both kinds of phrases; the mark tells base ones from own ones of the same label.
    named = {p: f"base:{label}" for p, label in BASE_PHRASES.items()} | OWN_PHRASES
    found = scan_licenses(docs, keep, named)
    base = F.filter("phrases", lambda x: x["label"].startswith("base:"))

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    plain = F.transform("phrases", lambda x: F.regexp_replace(x["label"], "^base:", ""))
    kept = [c for c in keep if c.lower() not in {"n_base", "base_labels", "labels", "first_word", "last_word"}]
    places = F.transform(base, lambda x: x["first_word"])
    return found.select(
        *[F.col(f"`{c}`") for c in kept], "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        joined(F.transform(base, lambda x: F.substring(x["label"], 6, 100))).alias("base_labels"),
        joined(F.concat(plain, F.transform("spans", lambda x: x["label"]))).alias("labels"), "score", "spans")
