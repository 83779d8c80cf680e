"""Quality rules: a decision list learned from labelled statistics, applied as a Spark expression.

``text_statistics`` counts in whole texts. ``learn_rules`` runs sequential covering over labelled rows
of statistics: each rule is a conjunction of thresholds, grown on one part of the rows by information
gain and pruned on the other. ``verdict`` turns the rules into one ordered ``CASE WHEN``.

Defined cases: a NULL or empty text has all counts 0. A NULL doc_id is counted like any other. Repeated
rows are counted each on their own. Without labels of both kinds no rule is learned and every text
passes. Long texts are counted whole. Extra columns are ignored by the query; the operator keeps them,
and replaces those that bear the name of a statistic.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_hash, smallest_by_hash, with_columns_of

#: The symbols of the base count.
SYMBOLS = "#*$%&|<>"

COUNTS = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "n_lines bigint, n_upper bigint, n_marks bigint, n_distinct bigint, longest_word bigint")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_UPPER = re.compile(r"[^\W\d_a-z]")


@dataclass(frozen=True)
class RuleParams:
    """``sample_rows`` bounds the labelled rows that are used for learning (smallest id hash first)."""

    sample_rows: int = 20_000
    max_rules: int = 12
    max_terms: int = 4
    cuts: int = 48
    min_precision: float = 0.9
    min_covered: int = 4


def _repeated(words: list[str]) -> int:
    """Positions inside 3-word windows that occur at least twice in the text."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    hit = bytearray(len(words))
    for i, w in enumerate(windows):
        if seen[w] > 1:
            hit[i:i + 3] = b"\1\1\1"
    return sum(hit)


def count_text(text: str | None) -> tuple[int, ...]:
    if not text:
        return (0,) * 10
    words = _WORD.findall(text)
    if not words:
        return (0, 0, 0, 0, 0, text.count("\n") + 1, 0, 0, 0, 0)
    lines = text.split("\n")
    full = [x for x in lines if x and _WORD.search(x)] if len(lines) > 1 else lines
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)),
            len(full) - len(set(full)), _repeated(words), len(lines),
            sum(c.isupper() for c in text) if not text.isascii() else len(_UPPER.findall(text)),
            text.count("!") + text.count("?"), len(set(words)), max(map(len, words)))


def text_statistics(docs: DataFrame, keep: tuple[str, ...] | None = None) -> DataFrame:
    """Documents with the counts of ``COUNTS`` for their whole text."""
    return with_columns_of(docs, lambda texts: list(zip(*map(count_text, texts))) or [[]] * 10,
                           COUNTS, keep=keep)


def features() -> dict[str, Column]:
    """What a threshold may be set on: counts and shares of the words."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return {"words": F.col("n_words").cast("double"), "word_length": F.col("word_chars") / n,
            "symbols": F.col("n_symbols") / n, "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
            "repeats": F.col("n_repeat_words") / n, "upper": F.col("n_upper") / chars,
            "marks": F.col("n_marks") / n, "distinct": F.col("n_distinct") / n,
            "longest": F.col("longest_word").cast("double")}


@dataclass(frozen=True)
class Rule:
    """All ``terms`` (feature, '>=' or '<=', threshold) hold: the text is rejected."""

    terms: tuple[tuple[str, str, float], ...]
    precision: float


def _holds(x: np.ndarray, names: list[str], terms) -> np.ndarray:
    ok = np.ones(len(x), bool)
    for name, op, cut in terms:
        v = x[:, names.index(name)]
        ok &= v >= cut if op == ">=" else v <= cut
    return ok


def _grow(x, bad, names, p: RuleParams) -> list[tuple[str, str, float]]:
    terms: list[tuple[str, str, float]] = []
    inside = np.ones(len(x), bool)
    while len(terms) < p.max_terms and (~bad[inside]).any():
        pos, neg = bad[inside].sum(), (~bad[inside]).sum()
        base, best = np.log2(pos / (pos + neg)) if pos else 0.0, (1e-9, None)
        for j, name in enumerate(names):
            v = x[inside, j]
            for cut in np.unique(np.quantile(v, np.linspace(0, 1, p.cuts), method="nearest")):
                for op, hit in ((">=", v >= cut), ("<=", v <= cut)):
                    a = (hit & bad[inside]).sum()
                    b = hit.sum() - a
                    if a >= p.min_covered:
                        gain = a * (np.log2(a / (a + b)) - base)
                        if gain > best[0]:
                            best = (gain, (name, op, float(cut)))
        if best[1] is None:
            break
        terms.append(best[1])
        inside &= _holds(x, names, terms[-1:])
    return terms


def _prune(terms, x, bad, names) -> list[tuple[str, str, float]]:
    """The shortest beginning of the conjunction with the best worth on rows it was not grown on."""
    def worth(part):
        hit = _holds(x, names, part)
        a, b = (hit & bad).sum(), (hit & ~bad).sum()
        return (a - b) / (a + b) if a + b else -1.0
    return max((terms[:k] for k in range(1, len(terms) + 1)), key=lambda t: (worth(t), -len(t)), default=[])


def learn_rules(x: np.ndarray, bad: np.ndarray, names: list[str], part: np.ndarray,
                p: RuleParams = RuleParams()) -> list[Rule]:
    """Sequential covering: rows that a rule covers are set aside before the next one is grown.

    ``part`` is True for the rows that grow rules; the others prune and judge them.
    """
    rules: list[Rule] = []
    left = np.ones(len(x), bool)
    while len(rules) < p.max_rules:
        g, h = left & part, left & ~part
        if bad[g].sum() < p.min_covered or not bad[h].any():
            break
        terms = _prune(_grow(x[g], bad[g], names, p), x[h], bad[h], names)
        hit = _holds(x, names, terms) if terms else np.zeros(len(x), bool)
        a, n = (bad & hit & left).sum(), (hit & left).sum()
        judged, right = (hit & h).sum(), (hit & h & bad).sum()
        if n < p.min_covered or not judged or right / judged < p.min_precision or a / n < p.min_precision:
            break
        rules.append(Rule(tuple(terms), round(float(a / n), 4)))
        left &= ~hit
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The index of the first rule that rejects the text, NULL where none does."""
    cols = features()
    expr = None
    for i, rule in enumerate(rules):
        cond = F.lit(True)
        for name, op, cut in rule.terms:
            cond = cond & (cols[name] >= F.lit(cut) if op == ">=" else cols[name] <= F.lit(cut))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return (F.lit(None).cast("int") if expr is None else expr).alias("rule")


def labelled_rows(docs: DataFrame, labels: DataFrame, p: RuleParams = RuleParams()):
    """Statistics, labels and the growing part of at most ``p.sample_rows`` labelled documents."""
    chosen = smallest_by_hash(labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
                              .groupBy("doc_id").agg(F.min("quality").alias("_quality")), "doc_id", p.sample_rows)
    # At most sample_rows rows of two numbers: small enough to be sent to every task.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    cols = features()
    got = (text_statistics(rows, ("doc_id", "_quality"))
           .select(id_hash("doc_id").alias("h"), "_quality", *[c.alias(n) for n, c in cols.items()])
           .orderBy("h", *cols).limit(2 * p.sample_rows).toPandas())
    return got[list(cols)].to_numpy(float), got["_quality"].to_numpy() == 0, list(cols), got["h"].to_numpy() % 3 != 0


def quality_verdicts(docs: DataFrame, labels: DataFrame, p: RuleParams = RuleParams(),
                     keep: tuple[str, ...] | None = None) -> DataFrame:
    """Documents with their statistics, ``base_failed``, the rejecting ``rule`` and ``kept``."""
    rules = learn_rules(*labelled_rows(docs, labels, p), p)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (text_statistics(docs, keep).withColumn("base_failed", failed).withColumn("rule", verdict(rules))
            .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()))
