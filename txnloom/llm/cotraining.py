"""Quality classifier by co-training of two views of a document.

One classifier reads the text (counts and shares of its words and lines, in bins), the other what is
known about the page (source, language, length and, where there is a ``url`` column, its parts). Both
start from labelled rows. In each round each view names its surest rows of both kinds among all unlabelled
ones, and these become training rows of the other view. In the end each view is calibrated on labelled rows that
it was not fitted on, and the sum of the calibrated log odds scores every document.

The fit uses at most ``labelled_rows`` labelled documents, those with the smallest id hashes, and the rows
that the views name: at most four times ``exchanged`` a round. Both views of all documents are computed once
and stored (some hundred bytes a document). In each round every task scores its unlabelled documents with
both views and keeps its few surest; a global order with a limit picks those that are named. Bins come
from the counts of all documents' values, rounded to ten binary digits. The last scoring is one pass
without any shuffle.

Defined cases: NULL and empty texts are scored by their counts (all 0); NULL metadata is a value of its
own. NULL ids are scored and never trained on. Repeated rows are scored each. Without labels of both
kinds every score is the share of good labels, or 0.5. Long texts are read whole. Extra columns are kept
where asked for; those named like a result are replaced.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import id_hash, map_batches, small_batches, smallest_by_hash, stored
from .quality_rules import count_text
from ..session import ship_package


@dataclass(frozen=True)
class CoParams:
    """``labelled_rows`` bounds the labelled rows used for training; unlabelled rows all take part."""

    labelled_rows: int = 20_000
    rounds: int = 5
    exchanged: int = 200
    least_sure: float = 0.9
    bins: int = 10
    slots: int = 64
    ridge: float = 1.0
    threshold: float = 0.5


# -- views --------------------------------------------------------------------

def text_numbers(text: str | None) -> list[float]:
    n_words, chars, symbols, dup_lines, repeats, lines, upper, marks, distinct, longest = count_text(text)
    w, c = max(n_words, 1), max(chars, 1)
    return [math.log1p(n_words), chars / w, symbols / w, dup_lines / max(lines, 1), repeats / w, upper / c, marks / w,
            distinct / w, math.log1p(longest), lines / w]


_URL = re.compile(r"^(?:(\w+)://)?([^/?#]*)([^?#]*)(\?[^#]*)?")


def page_slots(source, lang, n_chars, url, p: CoParams) -> list[int]:
    """Places of a page's properties in a vector of fixed length; one range of places per property."""
    values = [f"source={source}", f"lang={lang}", f"length={-1 if n_chars is None else int(math.log2(max(n_chars, 0) + 1) * 2)}"]
    if url:
        scheme, host, path, query = _URL.match(url).groups()
        values += [f"scheme={scheme}", f"deep={min((path or '').count('/'), 8)}", f"query={bool(query)}"]
        values += [f"host={part}" for part in re.split(r"[.\-]", host)]
    out = []
    for v in values:
        name = v.split("=", 1)[0]
        out.append((zlib.crc32(name.encode()) % 8) * p.slots + zlib.crc32(v.encode("utf-8", "surrogatepass")) % p.slots)
    return sorted(set(out))


def coarse(numbers: np.ndarray) -> np.ndarray:
    """Numbers of 0 and more cut to ten binary digits after the first, so that their distinct values can be counted."""
    return (np.ascontiguousarray(numbers, np.float32).view(np.uint32) & np.uint32(0xFFFFE000)).view(np.float32)


def cuts_of(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """Bin borders: quantiles of sorted distinct values with their counts."""
    upto = np.cumsum(counts)
    at = np.searchsorted(upto, np.linspace(0, 1, bins + 1)[1:-1] * upto[-1], side="left")
    return np.unique(values[np.minimum(at, len(values) - 1)])


@dataclass
class View:
    """A logistic classifier on binary features, with its calibration."""

    size: int
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    slope: float = 1.0
    shift: float = 0.0

    def fit(self, rows: list[list[int]], y: np.ndarray, ridge: float) -> None:
        """Newton steps; both kinds weigh the same."""
        x = _dense(rows, self.size)
        share = y.mean()
        weight = np.where(y, 0.5 / share, 0.5 / (1 - share))
        pull = np.append(np.full(self.size, ridge), 1e-6)
        w = np.zeros(self.size + 1)
        for _ in range(40):
            q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x.T * (weight * q * (1 - q))) @ x + np.diag(pull), x.T @ (weight * (q - y)) + pull * w)
            w -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
            if np.abs(step).max() < 1e-6:
                break
        self.weights = w

    def logits(self, rows: list[list[int]]) -> np.ndarray:
        return np.array([self.weights[r].sum() for r in rows]) + self.weights[-1]

    def sureness(self, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probabilities of a good document for rows given as their places one after the other."""
        logit = np.bincount(np.repeat(np.arange(len(lengths)), lengths), self.weights[flat], len(lengths)) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(self.slope * logit + self.shift, -30, 30)))

    def calibrate(self, logit: np.ndarray, y: np.ndarray) -> None:
        """Slope and shift that make the log odds honest, by Newton steps on smoothed targets."""
        target = np.where(y, (y.sum() + 1) / (y.sum() + 2), 1 / ((~y).sum() + 2))
        x = np.stack([logit, np.ones(len(logit))], 1)
        w = np.array([1.0, 0.0])
        for _ in range(50):
            q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x.T * (q * (1 - q))) @ x + 1e-3 * np.eye(2), x.T @ (q - target) + 1e-3 * (w - [1, 0]))
            w -= step
        self.slope, self.shift = max(float(w[0]), 0.0), float(w[1])

    def odds(self, rows: list[list[int]]) -> np.ndarray:
        return self.slope * self.logits(rows) + self.shift


def _dense(rows: list[list[int]], size: int) -> np.ndarray:
    x = np.zeros((len(rows), size + 1), np.float32)
    for i, r in enumerate(rows):
        x[i, r] = 1
    x[:, size] = 1
    return x


@dataclass
class CoModel:
    cuts: list[np.ndarray]
    text: View
    page: View
    prior: float
    trained: bool

    def text_rows(self, numbers: np.ndarray) -> list[list[int]]:
        """One bin per number."""
        return self.text_places(numbers).tolist() if len(numbers) else []

    def text_places(self, numbers: np.ndarray) -> np.ndarray:
        width, numbers = max((len(c) + 1 for c in self.cuts), default=1), coarse(numbers)
        return (np.stack([np.searchsorted(c, numbers[:, j], side="right") for j, c in enumerate(self.cuts)], 1)
                + np.arange(len(self.cuts)) * width)

    def scores(self, numbers: np.ndarray, pages: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Combined, text and page probability of a good document."""
        if not self.trained:
            same = np.full(len(pages), self.prior)
            return same, same, same
        a, b = self.text.odds(self.text_rows(numbers)), self.page.odds(pages)
        base = math.log(self.prior / (1 - self.prior))
        # Both views hold the prior once; their sum must not hold it twice.
        return tuple(1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (a + b - base, a, b))


# -- training -----------------------------------------------------------------

def _viewed(docs: DataFrame, keep: tuple[str, ...], p: CoParams) -> DataFrame:
    """Kept columns with the coarse numbers of the text and the places of the page."""
    extra = [c for c in ("source", "lang", "n_chars", "url") if c in docs.columns]
    held = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("_t"), *[F.col(c).alias(f"_{c}") for c in extra])
    new = StructType.fromDDL("numbers array<float>, page array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, len(keep)):
            numbers, pages = _read_views(b, len(keep), extra, p)
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(list(coarse(np.array(numbers))), pa.list_(pa.float32())), pa.array(pages, pa.list_(pa.int32()))],
                                             names=[*keep, "numbers", "page"])

    ship_package(docs.sparkSession)
    return held.mapInArrow(run, StructType(held.schema.fields[:len(keep)] + new.fields))


def _read_views(b: pa.RecordBatch, at: int, extra: list[str], p: CoParams):
    known = {c: b.column(at + 1 + k).to_pylist() for k, c in enumerate(extra)}
    none = [None] * b.num_rows
    numbers = [text_numbers(t) for t in b.column(at).to_pylist()]
    pages = [page_slots(*row, p) for row in zip(*(known.get(c, none) for c in ("source", "lang", "n_chars", "url")))]
    return numbers, pages


def _histogram(rows: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each number of a text its distinct coarse values and how many rows have them.

    A number has at most 1,024 values for each power of two, whatever the rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            numbers = _numbers(b.column(0))
            for j in range(numbers.shape[1]):
                values, counts = np.unique(numbers[:, j], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), j, np.int32)), pa.array(values), pa.array(counts.astype(np.int64))],
                                                 names=["j", "value", "n"])

    got = (map_batches(rows.select("numbers"), run, "j int, value float, n bigint").groupBy("j", "value").agg(F.sum("n").alias("n"))
           .toPandas().sort_values(["j", "value"]))
    return [(g["value"].to_numpy(np.float32), g["n"].to_numpy()) for _, g in got.groupby("j")]


def _numbers(lists: pa.Array) -> np.ndarray:
    return coarse(lists.flatten().to_numpy().reshape(len(lists), -1))


def _surest(free: DataFrame, model: CoModel, taken: set[int], most: tuple[int, int], least_sure: float) -> DataFrame:
    """Each task's surest rows that are not taken: (view, good, gap, tie, place, numbers, page), smallest gap first.

    ``most`` has how many rows of either kind are kept for each view.
    """
    # Ties go to the smaller hash of id and content; rows that are equal in it are alike.
    rows = free.select("place", "numbers", "page", F.xxhash64(F.col("doc_id").cast("string"), "numbers", "page").alias("tie"))
    gone = np.array(sorted(taken), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, bool], pa.Table] = {}
        for b in batches:
            b = b.filter(pa.array(~np.isin(b.column(0).to_numpy(), gone)))
            if not b.num_rows:
                continue
            texts = model.text_places(_numbers(b.column(1)))
            pages = b.column(2)
            sure = (model.text.sureness(texts.ravel(), np.full(len(texts), texts.shape[1])),
                    model.page.sureness(pages.flatten().to_numpy(), np.diff(np.asarray(pages.offsets))))
            for view, good in ((v, g) for v in (0, 1) for g in (False, True)):
                gap = 1 - sure[view] if good else sure[view]
                near = np.flatnonzero(gap <= 1 - least_sure)
                if not len(near):
                    continue
                new = pa.table({"gap": gap[near], "tie": b.column(3).take(pa.array(near)), "place": b.column(0).take(pa.array(near)),
                                "numbers": b.column(1).take(pa.array(near)), "page": pages.take(pa.array(near))})
                held = pa.concat_tables([best[view, good], new]) if (view, good) in best else new
                best[view, good] = held.take(pa.array(np.lexsort([held.column(c).to_numpy() for c in ("place", "tie", "gap")])[:most[view]]))
        for (view, good), held in best.items():
            held = held.combine_chunks()
            yield from pa.table({"view": pa.array(np.full(len(held), view, np.int32)), "good": pa.array(np.full(len(held), good)),
                                 **{c: held.column(c) for c in held.column_names}}).to_batches()

    return map_batches(rows, run, "view int, good boolean, gap double, tie bigint, place bigint, numbers array<float>, page array<int>")


def _named(free: DataFrame, model: CoModel, taken: set[int], p: CoParams) -> list[list[tuple[bool, list[float], list[int]]]]:
    """Rows that each view names among all free ones; the second view does not name those of the first."""
    # The first view may name up to two times ``exchanged`` of the second view's surest.
    most = (p.exchanged, 3 * p.exchanged)
    found = stored(_surest(free, model, taken, most, p.least_sure), "surest")
    tops = [found.where(f"view = {v} AND good = {g}").orderBy("gap", "tie", "place").limit(most[v]) for v in (0, 1) for g in ("false", "true")]
    rows = tops[0].unionByName(tops[1]).unionByName(tops[2]).unionByName(tops[3]).toPandas()
    out: list[list] = [[], []]
    for v in (0, 1):
        for g in (False, True):
            own = rows[(rows["view"] == v) & (rows["good"] == g) & ~rows["place"].isin(taken)].sort_values(["gap", "tie", "place"])[:p.exchanged]
            out[v] += [(g, list(n), list(map(int, x))) for n, x in zip(own["numbers"], own["page"])]
            taken.update(map(int, own["place"]))
    return out


def co_train(docs: DataFrame, labels: DataFrame, p: CoParams = CoParams()) -> CoModel:
    given = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("_y")))
    # Texts stay where they are and are read once; their numbers and pages are joined with the labels.
    seen = (_viewed(docs.where("doc_id IS NOT NULL"), ("doc_id",), p).join(given, "doc_id", "left")
            .select("doc_id", F.coalesce(F.col("_y").cast("int"), F.lit(-1)).alias("_y"), "numbers", "page",
                    F.monotonically_increasing_id().alias("place")))
    every = stored(seen, "views")
    chosen = smallest_by_hash(given.select("doc_id"), "doc_id", p.labelled_rows)
    rows = (every.where("_y >= 0").join(F.broadcast(chosen), "doc_id").withColumn("h", id_hash("doc_id"))
            .orderBy("h", "doc_id", "numbers", "page").limit(2 * p.labelled_rows).toPandas())
    y = rows["_y"].to_numpy()
    good = int((y == 1).sum())
    prior = good / len(y) if len(y) else 0.5
    if not good or good == len(y):
        return CoModel([], View(0), View(0), prior, False)
    cuts = [cuts_of(*h, p.bins) for h in _histogram(every)]
    width = max(len(c) + 1 for c in cuts)
    model = CoModel(cuts, View(width * len(cuts)), View(8 * p.slots), prior, True)
    text, page = model.text_rows(np.array(rows["numbers"].tolist(), float)), [list(map(int, r)) for r in rows["page"]]
    fold = rows["h"].to_numpy() % 5 == 0
    start, check = np.flatnonzero(~fold), np.flatnonzero(fold)
    if len(np.unique(y[start])) < 2 or len(np.unique(y[check])) < 2:
        start = check = np.arange(len(y))
    views = ((model.text, text), (model.page, page))
    known = [([feats[i] for i in start], [bool(y[i]) for i in start]) for _, feats in views]
    free, taken = every.where("_y < 0").select("doc_id", "numbers", "page", "place"), set()
    for turn in range(p.rounds + 1):
        for (view, feats), (own, kinds) in zip(views, known):
            view.fit(own, np.array(kinds), p.ridge)
            view.calibrate(view.logits([feats[i] for i in check]), y[check] == 1)
        if turn == p.rounds:
            break
        named = _named(free, model, taken, p)
        if not any(named):
            break
        for k, rows_of_view in enumerate(named):
            other = [r for _, _, r in rows_of_view] if k == 0 else model.text_rows(np.array([n for _, n, _ in rows_of_view], float))
            known[1 - k][0].extend(other)
            known[1 - k][1].extend(g for g, _, _ in rows_of_view)
    return model


def quality_scores(docs: DataFrame, model: CoModel, p: CoParams = CoParams(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Kept columns with ``quality_score``, ``text_score``, ``page_score`` and ``kept``."""
    new = StructType.fromDDL("quality_score double, text_score double, page_score double, kept boolean")
    kept = tuple(c for c in keep if c.lower() not in {f.name for f in new.fields})
    extra = [c for c in ("source", "lang", "n_chars", "url") if c in docs.columns]
    held = docs.select(*[F.col(f"`{c}`") for c in kept], F.col("text").alias("_t"), *[F.col(c).alias(f"_{c}") for c in extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, len(kept)):
            numbers, pages = _read_views(b, len(kept), extra, p)
            score, text, page = model.scores(np.array(numbers, float).reshape(len(pages), -1), pages)
            yield pa.RecordBatch.from_arrays([*b.columns[:len(kept)], *map(pa.array, (score, text, page, score >= p.threshold))],
                                             names=[*kept, *(f.name for f in new.fields)])

    ship_package(docs.sparkSession)
    return held.mapInArrow(run, StructType(held.schema.fields[:len(kept)] + new.fields))
