"""Toxicity by weak supervision.

Many small voters look at a text: one per group of insults, one per pattern, and one per word or word
beginning (with a least number of uses) that the labelled rows single out. A generative label model learns how far to trust them from their second
moments over all training texts: pairs that are independent given the class have a covariance of rank
one, which gives each voter's accuracy by triplets; what a pair has beyond that is its correlation. The
model's posteriors then label a bounded sample, and a linear classifier over votes and words is fitted
on those posteriors. Only the classifier scores.

Labels are read only where ``may_learn`` holds. Scores depend on the text alone.

Defined cases: NULL and empty texts get the score of a text without votes and words. A NULL doc_id is
scored and counts as not held out. Repeated rows are scored each. Without any toxic label the voters of
the fixed lists decide alone. An empty table gives an empty result. Long texts are read whole. Extra
columns are kept unless they bear the name of a result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_hash, map_batches, smallest_by_hash, with_columns_of

#: Insults by group, lower case.
LEXICON = {
    "intellect": "idiot idiots idiotic moron morons moronic imbecile stupid dumb dumbass stupidity brainless dimwit "
                 "halfwit cretin retard retarded dunce dolt numbskull simpleton airhead blockhead",
    "worth": "worthless useless loser losers pathetic failure nobody wretch lowlife",
    "filth": "trash scum garbage filth filthy vermin scumbag pig swine cockroach maggot rat dirtbag sleazebag",
    "disgust": "disgusting disgrace revolting repulsive vile gross ugly hideous sickening",
    "mockery": "clown clowns joke buffoon fool fools jerk jackass coward creep weirdo freak",
    "profanity": "shit bullshit fuck fucking fucker bastard bitch asshole arsehole dick prick crap whore slut "
                 "motherfucker cunt wanker twat",
    "german": "idioten dummkopf arschloch abschaum scheisse scheiße trottel depp hurensohn drecksau wichser vollidiot",
    "french": "connard connasse salaud imbécile abruti ordure merde crétin salope enculé",
    "spanish": "idiota estúpido imbécil basura pendejo cabrón mierda gilipollas puta maricón asqueroso",
}
#: Patterns of hostile address.
PATTERNS = {
    "address": rb"\byou(?:'re| are)? (?:an? |such an? |all )?(?:idiot|moron|loser|stupid|pathetic|worthless|disgusting|clown|fool|trash)",
    "threat": rb"\b(?:kill|hurt|beat|destroy) (?:you|yourself|them)\b",
    "dismissal": rb"\b(?:shut up|go to hell|drop dead|get lost|nobody (?:likes|cares))\b",
    "masked": rb"\b(?:f[*@#]+ck?|sh[*!1]+t|b[*!1]tch|a[*$]{2}hole|id[!1*]ot|st[*]pid|m[0*]ron)",
}

#: Lower case; everything between words that is not a letter, digit or apostrophe becomes a blank.
_CLEAN = bytes(ord(chr(b).lower()) if chr(b).isalpha() and b < 128 else b if b >= 128 or chr(b).isdigit() or b == 39
               else 32 for b in range(256))


@dataclass(frozen=True)
class ToxicParams:
    """``sample_rows`` bounds the labelled rows used, ``fit_rows`` the texts the classifier is fitted on."""

    sample_rows: int = 20_000
    fit_rows: int = 20_000
    mined: int = 48
    mined_min: int = 5
    mined_lift: float = 20.0
    vocabulary: int = 400
    ridge: float = 0.2
    rounds: int = 60
    label_logit: float = 4.0
    threshold: float = 0.7


@dataclass(frozen=True)
class ToxicModel:
    names: tuple[str, ...]
    groups: dict[bytes, int]
    patterns: tuple[tuple[int, bytes], ...]
    accuracy: tuple[float, ...] = ()
    correlation: np.ndarray | None = None
    #: Terms are words (``=word``) or beginnings with a least number of uses (``3^begin``).
    terms: dict[bytes, int] = field(default_factory=dict)
    weights: np.ndarray | None = None
    bias: float = 0.0


#: A beginning has this many bytes; it counts from these numbers of uses on.
BEGIN, USES = 5, (1, 2, 3, 5, 8)


def clean_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_CLEAN).split() if text else []


class Terms:
    """The terms of a fixed set that a text has, found without listing all others."""

    def __init__(self, terms: dict[bytes, int]):
        self.words = {t[1:]: k for t, k in terms.items() if t[:1] == b"="}
        self.begins: dict[bytes, list[tuple[int, int]]] = {}
        for t, k in terms.items():
            if t[:1] != b"=":
                self.begins.setdefault(t[2:], []).append((int(t[:1]), k))

    def of(self, words: list[bytes], distinct: set[bytes]) -> list[int]:
        hit = [self.words[w] for w in distinct & self.words.keys()]
        if self.begins:
            uses = Counter([w[:BEGIN] for w in words])
            for begin in uses.keys() & self.begins.keys():
                hit += [k for least, k in self.begins[begin] if uses[begin] >= least]
        return sorted(hit)


def all_terms(text: str | None) -> list[bytes]:
    words = clean_words(text)
    uses = Counter([w[:BEGIN] for w in words if len(w) >= BEGIN])
    return ([b"=" + w for w in set(words)]
            + [b"%d^%s" % (u, w) for w, n in uses.items() for u in USES if n >= u])


def voters(mined: list[bytes] = ()) -> ToxicModel:
    """The voters of the fixed lists, of the patterns, and one for each mined term."""
    names, groups, patterns = [], {}, []
    for name, words in LEXICON.items():
        for w in words.split():
            groups.setdefault(w.encode(), len(names))
        names.append(f"lexicon:{name}")
    for name, pattern in PATTERNS.items():
        patterns.append((len(names), pattern))
        names.append(f"pattern:{name}")
    own = {}
    for w in mined:
        own[w] = len(names)
        names.append(f"term:{w.decode('utf-8', 'replace')}")
    return ToxicModel(tuple(names), groups, tuple(patterns), terms=own)


def fixed_votes(model: ToxicModel, text: str, distinct: set[bytes]) -> list[int]:
    """Indices of the voters of fixed lists and patterns that call the text toxic; the others abstain."""
    hit = {model.groups[w] for w in distinct & model.groups.keys()}
    low = text.encode("utf-8", "surrogatepass").lower()
    return sorted(hit | {k for k, p in model.patterns if re.search(p, low)})


def may_learn(doc_id: str = "doc_id") -> Column:
    """Rows whose labels may be used."""
    return F.coalesce(F.pmod(id_hash(doc_id), F.lit(3)) != 1, F.lit(True))


def vote_moments(texts: DataFrame, model: ToxicModel) -> tuple[float, np.ndarray]:
    """Number of texts and the matrix of co-votes, added up in the tasks and then over them."""
    size = len(model.names)

    def run(batches):
        import pyarrow as pa
        total, n, terms = np.zeros((size, size)), 0, Terms(model.terms)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = clean_words(text)
                v = fixed_votes(model, text, set(words)) + terms.of(words, set(words)) if text else []
                n += 1
                if v:
                    total[np.ix_(v, v)] += 1
        yield pa.RecordBatch.from_pydict({"n": [n], "m": [total.ravel().tolist()]},
                                         pa.schema([("n", pa.int64()), ("m", pa.list_(pa.float64()))]))

    parts = map_batches(texts.select("text"), run, "n bigint, m array<double>")
    # One row per cell after partial sums: voters squared rows, whatever the number of texts.
    cells = (parts.select("n", F.posexplode("m").alias("cell", "v"))
             .groupBy("cell").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).toPandas())
    if cells.empty:
        return 0.0, np.zeros((size, size))
    return float(cells["n"].iloc[0]), cells.sort_values("cell")["v"].to_numpy().reshape(size, size)


def label_model(n: float, co: np.ndarray, prior: float,
                labelled: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How much likelier each voter fires on toxic texts, conditional correlations, and log likelihood ratios.

    For voters independent given the class, covariance_ij = prior (1 - prior) delta_i delta_j, so
    delta_i**2 follows from any triplet. A voter with no two partners takes ``labelled``, its difference
    of firing rates on labelled rows. What a pair's covariance has beyond the product is correlation.
    """
    m = len(co)
    mean = np.diag(co) / max(n, 1)
    cov = co / max(n, 1) - np.outer(mean, mean)
    spread = prior * (1 - prior)
    live = np.flatnonzero(mean > 0)
    delta = np.zeros(m)
    for i in live:
        got = [cov[i, j] * cov[i, k] / (cov[j, k] * spread) for j in live for k in live[live < j]
               if i not in (j, k) and min(cov[j, k], cov[i, j], cov[i, k]) > 1e-6]
        delta[i] = math.sqrt(np.median(got)) if len(got) >= 3 else labelled[i] if labelled is not None else mean[i] / prior / 2
    # Firing rates stay between 0 and 1 in both classes.
    delta = np.clip(delta, 0, np.minimum(mean / prior, (1 - mean) / (1 - prior)))
    within = cov - spread * np.outer(delta, delta)
    scale = np.sqrt(np.maximum(np.diag(within), 1e-9))
    correlation = np.clip(within / np.outer(scale, scale), 0, 1) if m else within
    np.fill_diagonal(correlation, 0)
    floor = 0.5 / max(n, 1)
    ratio = np.log(np.maximum(mean + (1 - prior) * delta, floor) / np.maximum(mean - prior * delta, floor))
    return delta, correlation, np.where(mean > 0, ratio, 0.0)


def vote_logit(fired: list[int], ratio: np.ndarray, correlation: np.ndarray) -> float:
    """Evidence of the voters that fired; a voter counts less the more it repeats others that fired."""
    if not fired:
        return 0.0
    return float((ratio[fired] / (1 + correlation[np.ix_(fired, fired)].sum(1))).sum())


def _platt(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make a logit a probability; slope positive."""
    a, b = 1.0, 0.0
    scale = max(np.abs(logit).max(initial=1.0), 1.0)
    x = logit / scale
    target = np.where(y, (y.sum() + 1) / (y.sum() + 2), 1 / ((~y).sum() + 2))
    for _ in range(2_000):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = p - target
        a, b = max(a - 4 * (g @ x) / len(x), 1e-3), b - 4 * g.mean()
    return a / scale, b


def _fit(rows: list[list[int]], target: np.ndarray, size: int, p: ToxicParams) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on soft labels by Newton steps; rows are lists of features."""
    x = np.zeros((len(rows), size + 1), np.float32)
    for i, r in enumerate(rows):
        x[i, r] = 1
    x[:, size] = 1
    ridge = np.full(size + 1, p.ridge)
    ridge[size] = 1e-6
    w = np.zeros(size + 1)
    for _ in range(p.rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (q * (1 - q))) @ x + np.diag(ridge), x.T @ (q - target) + ridge * w)
        w -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w[:size], float(w[size])


def train(docs: DataFrame, labels: DataFrame, p: ToxicParams = ToxicParams()) -> ToxicModel:
    usable = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(may_learn())
              .groupBy("doc_id").agg(F.max("toxic").alias("_toxic")))
    chosen = smallest_by_hash(usable, "doc_id", p.sample_rows)
    # At most sample_rows rows of two numbers go to every task.
    got = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    known = with_columns_of(got, lambda texts: [list(map(all_terms, texts))], "terms array<binary>",
                            keep=("doc_id", "_toxic"))
    # The terms that tell the classes apart, counted per term and class over the sample.
    both = got.agg(F.count("*").alias("n"), F.sum("_toxic").alias("t")).first()
    n_toxic, n_rest = int(both["t"] or 0), int(both["n"] - (both["t"] or 0))
    counts = (known.select("_toxic", F.explode("terms").alias("term")).groupBy("term")
              .agg(F.sum("_toxic").alias("t"), F.sum(1 - F.col("_toxic")).alias("c")))
    seen = F.col("t") + F.col("c")
    expected = seen * (n_toxic / max(n_toxic + n_rest, 1)) + 1e-3
    telling = (counts.where(seen >= p.mined_min)
               .withColumn("lift", (F.col("t") + 0.5) / (n_toxic + 1.0) / ((F.col("c") + 0.5) / (n_rest + 1.0)))
               .orderBy(((F.col("t") - expected) * (F.col("t") - expected) / expected).desc(), "term")
               .limit(p.vocabulary).toPandas())
    mined: list[bytes] = []
    for term, t, lift in zip(telling["term"], telling["t"], telling["lift"]):
        term = bytes(term)
        begin = term[1:1 + BEGIN] if term[:1] == b"=" else term[2:]
        # One voter per beginning: a second one would only repeat the first.
        if lift >= p.mined_lift and t >= p.mined_min and not any(
                begin == (m[1:1 + BEGIN] if m[:1] == b"=" else m[2:]) for m in mined):
            mined.append(term)
    model = voters(mined[:p.mined])
    n, co = vote_moments(docs.where(may_learn()), model)
    prior = min(max(n_toxic / max(n_toxic + n_rest, 1), 0.01), 0.5)

    # Posteriors on the bounded sample; features are the fixed votes and the telling terms.
    n_fixed = len(model.names) - len(model.terms)
    vocabulary = {bytes(w): n_fixed + k for k, w in enumerate(telling["term"])}

    def describe(texts):
        voting, known_terms = Terms(model.terms), Terms(vocabulary)
        fired, has = [], []
        for t in texts:
            words = clean_words(t)
            distinct = set(words)
            fixed = fixed_votes(model, t, distinct) if t else []
            fired.append(fixed + voting.of(words, distinct))
            has.append(fixed + known_terms.of(words, distinct))
        return [fired, has]

    sample = with_columns_of(got.select("doc_id", "text", "_toxic"), describe, "fired array<int>, has array<int>",
                             keep=("doc_id", "_toxic")).orderBy("doc_id").limit(p.fit_rows).toPandas()
    y = sample["_toxic"].to_numpy() == 1
    fired = [list(map(int, x)) for x in sample["fired"]]
    rates = np.zeros((2, len(model.names)))
    for f, toxic in zip(fired, y):
        rates[int(toxic), f] += 1
    delta, correlation, ratio = label_model(
        n, co, prior, rates[1] / max(y.sum(), 1) - rates[0] / max((~y).sum(), 1))
    if not y.any():
        return ToxicModel(model.names, model.groups, model.patterns, tuple(delta), correlation, {},
                          np.full(n_fixed, 4.0), -3.0)
    # The label of a row is one more voter, of a known high accuracy.
    logit = np.array([vote_logit(f, ratio, correlation) for f in fired]) + math.log(prior / (1 - prior))
    posterior = 1 / (1 + np.exp(-np.clip(logit + p.label_logit * (2.0 * y - 1), -30, 30)))
    lists = [list(map(int, h)) for h in sample["has"]]
    w, c = _fit(lists, posterior, n_fixed + len(vocabulary), p)
    # The score is calibrated on the labelled sample, so that 0.7 means what it says.
    z = np.array([w[f].sum() for f in lists]) + c
    s, t = _platt(z, y)
    return ToxicModel(model.names, model.groups, model.patterns, tuple(delta), correlation, vocabulary, w * s, c * s + t)


def score_texts(model: ToxicModel, texts: list[str | None]) -> list[float]:
    terms, out = Terms(model.terms), []
    for text in texts:
        words = clean_words(text)
        distinct = set(words)
        hit = fixed_votes(model, text, distinct) + terms.of(words, distinct) if text else []
        z = model.bias + float(model.weights[hit].sum())
        out.append(1 / (1 + math.exp(-min(max(z, -30.0), 30.0))))
    return out


def score_toxicity(docs: DataFrame, model: ToxicModel, keep: tuple[str, ...] | None = None) -> DataFrame:
    """Documents with ``toxic_score`` between 0 and 1."""
    return with_columns_of(docs, lambda texts: [score_texts(model, texts)], "toxic_score double", keep=keep)
