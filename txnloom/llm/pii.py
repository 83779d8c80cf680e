"""Personal data: fixed patterns, and a linear-chain conditional random field for what they miss.

``base_spans`` finds e-mail and IP addresses, card and phone numbers by pattern. The field reads word
shapes and a few telling words; it is trained on the small labelled table below and decoded by Viterbi
in numpy, many sequences at once. Its spans are added where no pattern span lies.

A sequence of the field is a stretch of words around *marked* words (with a digit, an at-sign or a
telling word): marked words at most ``GAP`` plain words apart, and ``GAP`` words more at both ends.
Words outside are not personal data.

Defined cases: NULL and empty texts have no spans. NULL ids and repeated rows pass through. Long texts
are read whole, in time linear in their length; spans are in code points, end exclusive. Spans of one
pattern never overlap; spans of different patterns may. Extra columns are kept where asked for; those
named like a result are replaced.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from .common import with_columns_of

#: Kinds in the order in which spans of one start are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
FIELD_KINDS = ("email", "phone", "card", "ssn", "iban", "secret", "name")
KINDS = BASE_KINDS + ("ssn", "iban", "secret", "name")

#: The labelled table, one sequence a line; spans are [kind words].
LABELLED = """
please call me at [phone 555-0101] tomorrow
call [phone (212) 555-0187] for details
please call [phone 555-0120] now
call [phone 555-0199] after six
phone: [phone 415-555-2671]
tel [phone 020 7946 0958] or ask at the desk
you can reach me on my mobile [phone 07700 900123] after five
my phone number is [phone 303-555-0142] and I am home
telephone [phone 030 901820] office hours only
fax: [phone 212.555.0199]
whatsapp [phone 07911 123456] any time
handy [phone 0171 1234567] bitte anrufen
téléphone [phone 01 42 68 53 00] le matin
teléfono [phone 91 411 11 11] por la tarde
mail me: [email jane dot doe at example dot com] thanks
write to [email sam at example dot org] please
email [email info (at) example (dot) net] for help
contact [email bob [at] example [dot] com] now
her ssn is [ssn 078-05-1120] on the form
SSN: [ssn 219-09-9999]
social security number [ssn 457-55-5462] was used
ssn [ssn 123-45-6789]
pay to iban [iban DE89370400440532013000] today
IBAN: [iban GB29NWBK60161331926819]
account iban [iban FR1420041010050500013M02606] please
visa card number [card 4111-1111-1111-1112] expires soon
credit card [card 4012888888881882] on file
my card is [card 5500 0000 0000 0005] and works
password = [secret hunter2horse9]
password: [secret Tr0ub4dor3x]
api_key = [secret 9f86d081884c7d659a2feaa0c55ad015]
token = [secret "d41d8cd98f00b204e9800998ecf8427e12345678"] in the file
token = [secret "46d6a7e6a8a7bb8c02c2f090c991ec47d826f64d"] and then
the token = [secret "333d5d5b767fa42c7d1f6b009b99b44ac76c0fe2"] of
secret: [secret a94a8fe5ccb19ba61c4c0873d391e987982fbbd3]
my name is [name Maria Lopez] and I live here
my name is [name John Smith] from the office
his name is [name Peter Miller] he said
the name is [name Anna] by the way
the meeting is on 2021-05-14 at 10:30 in room 12
version 2.0 of the license from 2004
GNU General Public License, version 3.
Licensed under CC BY-NC 4.0.
under the Apache License, Version 2.0.
it costs 19.99 dollars or 1,250 euros
chapter 7 page 212 line 14
in 1984 and 1999 there were 12 of them
order number 4412473014894482 has shipped
the number 4668350087416800 stands and
parcel 9913866557355100 left the house
call the function with 3 arguments
call it a day at 5 or 6
the phone has 128 GB and 2 cameras
his card was number 7 of 52
we token 40 times a day
the name of the street is long 12 or more
scores were 3-1 and 2-0 at half time
between 1939-1945 and 2020-2021
see section 4.2.1 and table 10
@home and @work are tags of 2 lists
meet at noon or at 7 at the dot
password of the week was 7 letters long
about 555 people and 0101 in binary
the secret is out after 20 years
room 415-A on floor 26
the mail came at 9 in the 3rd week
| 12 | 45 | 1022 | 7
a1b2 c3d4 is a label of 8 signs
item 20-7946 and part 0958-11
"""

GAP = 4
_TELLING = ("call phone tel telephone mobile fax cell whatsapp handy téléphone teléfono reach number contact mail "
            "email write ssn social security iban account card visa credit password passwd api_key apikey token secret "
            "key name is my at dot (at) (dot) [at] [dot] order version license parcel").split()
_MARKING = re.compile(r"[0-9@]|\b(?:ssn|iban|password|passwd|api_?key|name\s+is|dot|whatsapp)\b|[(\[](?:at|dot)[)\]]", re.I)
_NAMED = re.compile(r"\bname\s+is\s+\Z", re.I)
_CARDED = re.compile(r"\b(?:card|visa|mastercard|credit)\b", re.I)
_WORD = re.compile(r"[^\s]+")
_EDGE = ".,;:!?\"'|*#%&$<>{}"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HAS_DIGIT = re.compile(r"[0-9]")


# -- patterns -----------------------------------------------------------------

def _emails(text: str):
    at, floor = text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            floor = domain.end()
            yield start, floor
        at = text.find("@", max(at + 1, floor))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _ips(text: str):
    for run in _NUMBERS.finditer(text):
        if run.group().count(".") >= 3:
            parts = list(re.finditer(r"[0-9]+", run.group()))
            for k in range(0, len(parts) - 3, 4):
                four = parts[k:k + 4]
                if all(_small(m.group()) for m in four):
                    yield run.start() + four[0].start(), run.start() + four[3].end()


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(filter(str.isdigit, text))


def _cards(text: str):
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37:
            d = _digits(m.group())
            if 12 <= len(d) <= 19 and luhn(d):
                yield m.start(), m.end()


def _phones(text: str):
    for m in _PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            yield m.start(), m.end()


def base_spans(text: str | None) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the patterns, by start and then kind."""
    if not text:
        return []
    found = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _HAS_DIGIT.search(text):
        found += [(a, 1, b) for a, b in _ips(text)] + [(a, 2, b) for a, b in _cards(text)]
        if "+" in text:
            found += [(a, 3, b) for a, b in _phones(text)]
    return [(a, BASE_KINDS[k], b) for a, k, b in sorted(found)]


# -- the field ----------------------------------------------------------------

TAGS = ("O", *(f"{p}-{k}" for k in FIELD_KINDS for p in "BI"))
_ALLOWED = np.array([[t[0] != "I" or s[2:] == t[2:] for t in TAGS] for s in TAGS])
_STARTS = np.array([t[0] != "I" for t in TAGS])


def _shape(word: str) -> str:
    """Letters as x or X, digits as 9, in runs of at most three; other signs stay."""
    s = re.sub(r"[^\W\d_]", lambda m: "X" if m.group().isupper() else "x", word[:64])
    return re.sub(r"(.)\1{3,}", r"\1\1\1", re.sub(r"[0-9]", "9", s))[:16]


def word_features(word: str) -> tuple[str, ...]:
    """Features of one word; those of short words are kept, within some 10 MB a worker."""
    return _kept_features(word) if len(word) <= 40 else _features(word)


def _features(word: str) -> tuple[str, ...]:
    core = word.strip(_EDGE)
    low, digits = core.lower(), sum("0" <= c <= "9" for c in core[:64])
    out = [f"s={_shape(core)}", f"n={min(digits, 20)}", f"l={min(len(core), 24) // 4}",
           f"mix={any(c.isalpha() for c in core[:64]) and digits > 0}", f"end={word[-1:] in ',;.:!?'}"]
    if low in _TELLING or word.lower() in _TELLING:
        out.append(f"w={low or word.lower()}")
    if core[:1].isupper():
        out.append("cap")
    if re.fullmatch(r"[0-9a-f]{24,}", low):
        out.append("hex")
    if re.fullmatch(r"[A-Z]{2}[0-9]{2}[0-9A-Z]{10,30}", core):
        out.append("iban")
    return tuple(out)


_kept_features = lru_cache(maxsize=20_000)(_features)


class Field:
    """Weights per feature and tag for the word itself (0), the two before (-2, -1) and the two after (1, 2)."""

    AROUND = (0, -1, 1, -2, 2)

    def __init__(self, names: dict[tuple[int, str], int]):
        self.names = names
        self.weights = np.zeros((len(names), len(TAGS)))
        self.moves = np.zeros((len(TAGS), len(TAGS)))
        self.first = np.zeros(len(TAGS))

    def features(self, words: list[str]) -> list[list[int]]:
        every = [word_features(w) for w in words]
        out = []
        for i in range(len(words)):
            got = []
            for o in self.AROUND:
                if 0 <= i + o < len(words):
                    got += [self.names[o, f] for f in every[i + o] if (o, f) in self.names]
                elif (o, "none") in self.names:
                    got.append(self.names[o, "none"])
            out.append(got)
        return out

    def emissions(self, words: list[str]) -> np.ndarray:
        return np.array([self.weights[f].sum(0) for f in self.features(words)])


def labelled_sequences(table: str = LABELLED) -> list[tuple[list[str], list[str]]]:
    out = []
    for line in filter(None, map(str.strip, table.splitlines())):
        words, tags, kind, fresh = [], [], None, False
        for w in line.split():
            opened = w[0] == "[" and w[1:] in FIELD_KINDS
            if opened:
                kind, fresh = w[1:], True
                continue
            closes = kind is not None and w.endswith("]") and w not in ("[at]", "[dot]")
            words.append(w[:-1] if closes else w)
            tags.append("O" if kind is None else f"{'B' if fresh else 'I'}-{kind}")
            fresh = False
            if closes:
                kind = None
        out.append((words, tags))
    return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


@lru_cache(maxsize=1)
def train_field(table: str = LABELLED, rounds: int = 120, rate: float = 0.5, ridge: float = 0.02) -> Field:
    """Maximum likelihood with ridge by adaptive gradient steps; the table is small, so on one machine."""
    data = labelled_sequences(table)
    names: dict[tuple[int, str], int] = {}
    for words, _ in data:
        for i in range(len(words)):
            for o in Field.AROUND:
                for f in (word_features(words[i + o]) if 0 <= i + o < len(words) else ("none",)):
                    names.setdefault((o, f), len(names))
    field = Field(names)
    gold = [np.array([TAGS.index(t) for t in tags]) for _, tags in data]
    feats = [field.features(words) for words, _ in data]
    barred = np.where(_ALLOWED, 0.0, -1e4)
    at_start = np.where(_STARTS, 0.0, -1e4)
    sums = [np.full_like(w, 1e-2) for w in (field.weights, field.moves, field.first)]
    for _ in range(rounds):
        gw, gm, gf = ridge * field.weights, ridge * field.moves, ridge * field.first
        for fs, y in zip(feats, gold):
            e = np.array([field.weights[f].sum(0) for f in fs])
            move, n = field.moves + barred, len(y)
            fwd, bwd = np.zeros_like(e), np.zeros_like(e)
            fwd[0] = e[0] + field.first + at_start
            for t in range(1, n):
                fwd[t] = e[t] + _log_sum(fwd[t - 1][:, None] + move, 0)
            for t in range(n - 2, -1, -1):
                bwd[t] = _log_sum(move + (e[t + 1] + bwd[t + 1])[None, :], 1)
            z = _log_sum(fwd[-1], 0)
            p = np.exp(fwd + bwd - z)
            p[np.arange(n), y] -= 1
            for t, f in enumerate(fs):
                gw[f] += p[t]
            gf += p[0]
            for t in range(1, n):
                gm += np.exp(fwd[t - 1][:, None] + move + (e[t] + bwd[t])[None, :] - z)
                gm[y[t - 1], y[t]] -= 1
        for w, g, s in zip((field.weights, field.moves, field.first), (gw, gm, gf), sums):
            s += g * g
            w -= rate * g / np.sqrt(s)
    field.moves += barred
    field.first += at_start
    return field


def viterbi(field: Field, sequences: list[np.ndarray]) -> list[np.ndarray]:
    """Best tags of many sequences at once; they are padded to the longest of their batch."""
    out: list[np.ndarray] = [np.zeros(0, int)] * len(sequences)
    order = sorted(range(len(sequences)), key=lambda k: len(sequences[k]))
    for at in range(0, len(order), 256):
        part = order[at:at + 256]
        sizes = np.array([len(sequences[k]) for k in part])
        e = np.zeros((len(part), sizes[-1], len(TAGS)))
        for r, k in enumerate(part):
            e[r, :sizes[r]] = sequences[k]
        score, back = e[:, 0] + field.first, np.zeros(e.shape, np.int8)
        for t in range(1, e.shape[1]):
            step = score[:, :, None] + field.moves
            back[:, t] = step.argmax(1)
            moved = step.max(1) + e[:, t]
            score = np.where((t < sizes)[:, None], moved, score)
        tag = score.argmax(1)
        for r, k in enumerate(part):
            path = np.empty(sizes[r], int)
            path[-1] = tag[r]
            for t in range(sizes[r] - 1, 0, -1):
                path[t - 1] = back[r, t, path[t]]
            out[k] = path
    return out


def sequences_of(text: str) -> list[list[tuple[int, int]]]:
    """Word places of the stretches around marked words."""
    out: list[list[tuple[int, int]]] = []
    last_end = -1
    for mark in _MARKING.finditer(text):
        if mark.start() < last_end and out:
            continue
        # Words from GAP before the mark on: step back over blanks, never past the last stretch.
        floor = out[-1][-1][1] if out else 0
        at = mark.start()
        for _ in range(GAP + 1):
            while at > floor and not text[at - 1].isspace():
                at -= 1
            if at > floor and _ < GAP:
                while at > floor and text[at - 1].isspace():
                    at -= 1
        stretch = out[-1] if out and not text[floor:at].strip() else []
        fresh, left = not stretch, GAP
        for w in _WORD.finditer(text, at if fresh else floor):
            stretch.append((w.start(), w.end()))
            if w.end() > mark.start():
                left = GAP + 1 if _MARKING.search(text, w.start(), w.end()) else left
                left -= 1
                if left <= 0:
                    break
        if fresh and stretch:
            out.append(stretch)
        last_end = stretch[-1][1] if stretch else last_end
    return out


def field_spans(field: Field, texts: list[str | None]) -> list[list[tuple[int, str, int]]]:
    """Spans of the field in every text."""
    places, emissions, owner = [], [], []
    for k, text in enumerate(texts):
        for stretch in sequences_of(text) if text else ():
            places.append(stretch)
            emissions.append(field.emissions([text[a:b] for a, b in stretch]))
            owner.append(k)
    out: list[list[tuple[int, str, int]]] = [[] for _ in texts]
    for k, stretch, tags in zip(owner, places, viterbi(field, emissions)):
        text, open_at, kind, end = texts[k], None, "", 0
        for (a, b), tag in [*zip(stretch, tags), ((0, 0), 0)]:
            name = TAGS[tag]
            if open_at is not None and name[0] != "I":
                s, e = open_at, end
                while s < e and text[s] in _EDGE:
                    s += 1
                while e > s and text[e - 1] in _EDGE:
                    e -= 1
                named = {"name": _NAMED, "card": _CARDED}.get(kind)
                if _plausible(kind, text[s:e]) and (named is None or named.search(text, max(0, s - 40), s)):
                    out[k].append((s, kind, e))
                open_at = None
            if name[0] == "B":
                open_at, kind = a, name[2:]
            end = b
    return out


def _plausible(kind: str, span: str) -> bool:
    """What a span of a kind must have at least; the field cannot count digits over words."""
    n = sum("0" <= c <= "9" for c in span)
    letters = sum(c.isalpha() for c in span)
    return bool(span) and {"phone": 7 <= n <= 15 and letters == 0, "card": 12 <= n <= 19 and letters == 0,
                           "ssn": n == 9 and letters == 0, "iban": n >= 8 and 14 <= len(span) <= 42,
                           "secret": len(span) >= 8 and n >= 1, "email": letters >= 6,
                           "name": n == 0 and letters >= 2}[kind]


def find_spans(texts: list[str | None], field: Field) -> tuple[list, list]:
    """Pattern spans, and all spans with those of the field that touch none of them."""
    base = [base_spans(t) for t in texts]
    every = []
    for own, added in zip(base, field_spans(field, texts)):
        extra = [s for s in added if not any(s[0] < b and a < s[2] for a, _, b in own)]
        every.append(sorted(own + extra, key=lambda s: (s[0], KINDS.index(s[1]), s[2])))
    return base, every


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, k, b in spans)


def personal_data(docs: DataFrame, keep: tuple[str, ...] | None = None) -> DataFrame:
    """Documents with counts per pattern, the digest of the pattern spans, and all ``spans``."""
    field = train_field()

    def make(texts):
        base, every = find_spans(texts, field)
        counts = [[sum(k == kind for _, k, _ in s) for s in base] for kind in BASE_KINDS]
        return [*counts, [hashlib.sha256(joined(s).encode()).hexdigest() for s in base], [joined(s) for s in every]]
    return with_columns_of(docs, make, "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
                                       "base_sha256 string, spans string", keep=keep)


def masked(text: str | None, spans: list[tuple[int, str, int]]) -> str | None:
    """The text with every span, overlapping ones as one, replaced by its kind in brackets."""
    out, at = [], 0
    for a, kind, b in spans:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return text if not spans else "".join(out) + text[at:]


def mask_personal_data(docs: DataFrame) -> DataFrame:
    """Documents, all columns kept, with personal data masked in ``text``."""
    field = train_field()

    def make(texts):
        return [[masked(t, s) for t, s in zip(texts, find_spans(texts, field)[1])]]
    return with_columns_of(docs, make, "text string").select(*docs.columns)
