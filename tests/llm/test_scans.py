"""Licence scans, phrases and conversations against brute force, with the odd cases each docstring defines."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from txnloom.llm import conversations, license_scan, phrases

SF = "/root/testdata/sf0.001"
ODD = [None, "", " \n\t ", "a", "a a a a a", "x" * 20_000, "é ü 日本 \U0001f600", "one\n\none\none two", "\n\n \n", "a  b   c \n  d "]


def rows_of(spark, texts=ODD):
    return spark.createDataFrame([(None if i == 0 else i, t, "s", "x") for i, t in enumerate(texts)],
                                 "doc_id long, text string, score string, Labels string")


def no_rows(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string")


# -- licence scans ------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_phrases(words, phrase_list):
    return sorted((k, i) for k, p in enumerate(phrase_list) for i in range(len(words)) if words[i:i + len(p)] == p)


def plain_matches(words, templates, least):
    out = set()
    for t, seq in enumerate(templates):
        for i in range(len(words)):
            for j in range(len(seq)):
                if words[i] == seq[j] and not (i + 1 < len(words) and j + 1 < len(seq) and words[i + 1] == seq[j + 1]):
                    n = 1
                    while i - n >= 0 and j - n >= 0 and words[i - n] == seq[j - n]:
                        n += 1
                    if n >= least:
                        out.add((t, i + 1 - n, j + 1 - n, n))
    return out


def test_matching_statistics_find_every_maximal_match():
    rng = random.Random(5)
    for trial in range(60):
        letters = "abc" if trial % 2 else "abcdefgh"
        make = lambda n: " ".join(rng.choice(letters) for _ in range(n))
        names = {make(rng.randint(2, 3)): f"p{k}" for k in range(3)}
        templates = [(f"t{k}", f"l{k}", make(rng.randint(4, 25))) for k in range(4)]
        p = license_scan.ScanParams(least=rng.choice([2, 4]), block=rng.choice([1, 3, 7, 1 << 20]))
        scanner = license_scan.LicenseScanner(names, templates, p)
        text = " ".join(rng.choice([make(3), "zz", templates[0][2], templates[1][2][:9]]) for _ in range(12))
        got, words = scanner.scan(text), plain_words(text)
        assert got.n_words == len(words)
        assert sorted(got.phrases) == plain_phrases(words, [plain_words(x) for x in names])
        assert len(got.matches) == len(set(got.matches))
        assert set(got.matches) == plain_matches(words, [plain_words(x) for _, _, x in templates], p.least)


def test_chains_cover_edited_templates():
    scanner = license_scan.LicenseScanner({}, license_scan.TEMPLATES)
    for t, (_, _, text) in enumerate(license_scan.TEMPLATES):
        words = plain_words(text)
        edited = "before it all " + " ".join("Other" if len(words) > 60 and i % 15 == 9 else w for i, w in enumerate(words)) + " and more"
        best = max((s for s in scanner.spans(scanner.scan(edited).matches) if s[0] == t), key=lambda s: s[3])
        assert best[3] / scanner.sizes[t] > 0.8 and best[1] == 3 and len(words) - 4 <= best[2] <= len(words) + 3
    # Two copies give two spans; shuffled words none worth a label.
    twice = scanner.spans(scanner.scan(license_scan.TEMPLATES[2][2] + " x " * 50 + license_scan.TEMPLATES[2][2]).matches)
    assert sum(t == 2 and c == scanner.sizes[2] for t, _, _, c in twice) == 2
    mixed = plain_words(license_scan.TEMPLATES[0][2])
    random.Random(1).shuffle(mixed)
    assert all(c / scanner.sizes[t] < 0.3 for t, _, _, c in scanner.spans(scanner.scan(" ".join(mixed)).matches))


def test_license_report_against_plain_search(spark):
    texts = ODD + ["The MIT license.", "mit-LICENSE Apache  License; apache\nlicense", "GNU General Public License",
                   "mitlicense", "emit license", "Licensed under CC BY-NC 4.0.", license_scan.TEMPLATES[0][2],
                   "é mit licenseé", "mit license " * 40_000, "MIT LICENSE", "MIT LICENSE"]
    got = license_scan.license_report(rows_of(spark, texts), keep=("doc_id", "Labels")).orderBy(F.col("doc_id").asc_nulls_first()).collect()
    base = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
    for row, text in zip(got, texts):
        words = plain_words(text)
        places = [(k, i) for k, (p, _) in enumerate(base) for n in [len(p.split())] for i in range(len(words)) if words[i:i + n] == p.split()]
        assert (row.n_words, row.n_base) == (len(words), len(places))
        assert (row.first_word, row.last_word) == ((min(i for _, i in places), max(i for _, i in places)) if places else (None, None))
        found = {base[k][1] for k, _ in places}
        assert row.base_labels == ",".join(sorted(found)) and found <= set(row.labels.split(",")) | {""}
        assert row.score == 1.0 if places else 0 <= row.score <= 1
    assert [got[i].labels for i in (15, 16)] == ["cc-by,cc-by-nc", "mit"] and got[16].base_labels == ""
    assert license_scan.license_report(no_rows(spark)).count() == 0


def test_license_query(spark):
    from txnloom.llm.queries import QUERIES
    got = QUERIES["op11_license_scan"](spark, SF)
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in got.collect():
        words = " " + " ".join(plain_words(texts[r.doc_id])) + " "
        assert r.n_words == len(plain_words(texts[r.doc_id]))
        assert r.base_labels == ",".join(x for p, x in (("apache license", "apache"), ("general public license", "gpl"), ("mit license", "mit"))
                                         if f" {p} " in words)


# -- phrases ------------------------------------------------------------------

def plain_collocations(rows, least, longest, top):
    counts, total = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, longest + 1):
                counts.update((lang, tuple(words[i:i + n])) for i in range(len(words) - n + 1))
    held = {k: v for k, v in counts.items() if v >= least}
    covered = {(lang, w[i:j]) for (lang, w), f in held.items() for i in range(len(w)) for j in range(i + 1, len(w) + 1)
               if j - i < len(w) and held[lang, w[i:j]] <= f}
    by_lang = collections.defaultdict(list)
    for (lang, w), a in held.items():
        if len(w) > 1 and (lang, w) not in covered:
            score, _, l, r = min((1000 * a * total[lang] // (held[lang, w[:k]] * held[lang, w[k:]]), k, held[lang, w[:k]], held[lang, w[k:]])
                                 for k in range(1, len(w)))
            by_lang[lang].append((-score, -a, " ".join(w).encode(), " ".join(w), l, r))
    return sorted((lang, k, x[3], -x[1], x[4], x[5], total[lang], -x[0]) for lang, xs in by_lang.items() for k, x in enumerate(sorted(xs)[:top], 1))


def phrase_rows(rng):
    texts = [" ".join(rng.choice(["the", "The", "of", "cat", "dog", "a b c d e f", "été", "x\x1cy", "."]) + rng.choice([" ", "  ", "\t", ",", "\n"])
                      for _ in range(rng.randint(0, 60))) for _ in range(60)]
    return [(rng.choice(["en", "fr", None, "und"]), t) for t in texts] + [("en", t) for t in ODD] + [("en", "the cat of the cat")] * 9


def test_collocations_against_brute_force(spark):
    rows = phrase_rows(random.Random(2))
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    for kw in ({}, {"shard_words": 50}, {"shard_words": 50, "filter_bits": 1 << 15}, {"longest": 3}, {"top": 4}):
        p = phrases.PhraseParams(**{"least": 4, "top": 500, **kw})
        got = phrases.collocations(docs, p)
        assert sorted(map(tuple, got.collect())) == plain_collocations(rows, 4, p.longest, p.top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert phrases.collocations(no_rows(spark)).count() == 0


def test_intervals_on_both_sides_agree_with_counts():
    rng = np.random.default_rng(4)
    ids = np.concatenate(([0], np.where(rng.random(3000) < 0.1, 0, rng.integers(1, 6, 3000)), [0])).astype(np.int32)
    index = phrases.ShardIndex(phrases.transform(ids, 5), phrases.transform(ids[::-1], 5), 5)
    for sides in ((True,) * 4, (False,) * 4, (True, False, True, False), (False, False, True, True)):
        grams = index.single()
        for n, left in enumerate(sides, 2):
            grams = index.extend(grams, left)
            plain = collections.Counter(t for t in zip(*(ids[k:len(ids) - n + 1 + k].tolist() for k in range(n))) if 0 not in t)
            assert dict(zip(map(tuple, grams.ids.tolist()), grams.count.tolist())) == plain


def test_score_is_exact_beyond_64_bits(spark):
    rng = random.Random(8)
    rows = [(a := rng.randrange(1, 10**13), rng.randrange(10**13, 10**14), a + rng.randrange(10**13), a + rng.randrange(10**3)) for _ in range(200)]
    got = spark.createDataFrame(rows, "f long, n long, l long, r long").withColumn("score", phrases.cut_score("f", "n", "l", "r")).collect()
    assert [r.score for r in got] == [1000 * a * n // (l * r) for a, n, l, r in rows]


def test_filter_holds_every_phrase(spark):
    p = phrases.PhraseParams(filter_bits=1 << 17)
    hashes = np.array([[phrases._word_hash(f"w{i}".encode()), phrases._word_hash(f"v{i * i}".encode())] for i in range(3000)], np.uint64)
    rows = [(int(b),) for b in phrases._buckets(hashes, "en")]
    filled = phrases.bucket_filter(spark.createDataFrame(rows, "bucket long"), p)
    assert len(filled) * 8 == 1 << 17 and phrases._has(filled, hashes, "en").all()
    assert phrases._has(filled, hashes[:, ::-1], "en").mean() < 0.1


# -- conversations ------------------------------------------------------------

def plain_edits(faults):
    """(cost, edits) of the cheapest, then least, edit string for (fault, initial) rows, by relaxation over whole strings."""
    follow = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best = {"": (0, ""), "a": (0, "")}
    for row in [None, *reversed(faults)]:
        new = {} if row else best
        for state in follow:
            made = "a" if state == "u" else "u"
            options = [new[state]] if state in new else []
            if row:
                fault, initial = row
                extra = 3 if fault == "truncated" else 0
                if state in best:
                    options.append((best[state][0] + 4, "D" + best[state][1]))
                if fault not in ("blank", "duplicate"):
                    if follow[state].get(initial) in best:
                        options.append((best[follow[state][initial]][0] + extra, "K" + best[follow[state][initial]][1]))
                    if made in best:
                        options.append((best[made][0] + 3 + extra, "R" + best[made][1]))
            if options:
                new[state] = min(options)
        for _ in range(4):
            for state in follow:
                made = "a" if state == "u" else "u"
                if made in new:
                    new[state] = min(new.get(state, (10**9, "")), (new[made][0] + 3, "I" + new[made][1]))
        best = new
    return best[""]


def plain_repair(rows):
    """The contract for rows (conv_id, turn, role, text), step by step."""
    by_conv = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        by_conv[conv] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = []
    for conv, found in by_conv.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, seen = [], set()
        for _, role, text in found:
            said = re.findall("[^\x20\x09-\x0D]", text)
            faults.append(("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "", role[:1]))
            seen.add((role, text))
        turns = [t for t, _, _ in found if t is not None]
        cost, audit = plain_edits(faults)
        state, at, lines = "", 0, []
        for letter in audit:
            role = "assistant" if state == "u" else "user"
            if letter != "I":
                at += 1
            if letter == "K":
                role = found[at - 1][1]
            if letter != "D":
                lines.append(f"{role}:{found[at - 1][2] if letter != 'I' else ''}")
                state = role[0]
        kinds = collections.Counter(f for f, _ in faults)
        illegal = sum(a + b not in ("su", "ua", "au") for (_, a), (_, b) in zip(faults, faults[1:]))
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, kinds["blank"], kinds["duplicate"],
                    kinds["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def conversation_rows(rng, n=120):
    rows = []
    for conv in [None, *range(n)]:
        for turn in [None] * (rng.random() < 0.2) + sorted(rng.sample(range(12), rng.randint(0, 9))):
            rows += [(conv, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                      rng.choice(["Yes.", "no", "Fine!", " ", "", None, "é日?", "Why? \n", "x"]))] * (1 + (rng.random() < 0.1))
    return rows


def test_auction_finds_the_least_cheapest_edits():
    rng = random.Random(3)
    p = conversations.RepairParams()
    names = {"": conversations.FINE, "blank": conversations.BLANK, "duplicate": conversations.DUPLICATE, "truncated": conversations.CUT}
    for _ in range(3000):
        faults = [(rng.choice(["", "", "", "blank", "duplicate", "truncated"]), rng.choice("uuaasx") or "") for _ in range(rng.randint(0, 9))]
        layers = [conversations.row_layer(names[f], c, p) for f, c in faults] + [conversations.end_layer(p)]
        price = conversations.auction(layers, conversations.END)
        assert (price[0][0], conversations.trace(layers, price, 0)[0]) == plain_edits(faults)


def test_repair_against_plain_steps_whole_and_in_blocks(spark):
    rows = conversation_rows(random.Random(7))
    rows += [(999, t, "user" if t % 3 else "assistant", f"turn {t % 40}.") for t in range(300)] + [(1000, 5, "user", "same.")] * 40
    ddl = "conv_id long, turn long, role string, text string, audit string"
    docs = spark.createDataFrame([(*r, "clash") for r in rows], ddl).repartition(3)
    want = plain_repair(rows)
    for kw in ({}, {"block_rows": 1}, {"block_rows": 3}, {"block_bytes": 20}):
        got = conversations.repair_conversations(conversations.damaged(docs), conversations.RepairParams(**kw))
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert conversations.repair_conversations(conversations.damaged(spark.createDataFrame([], ddl))).count() == 0


def test_repaired_turns_hash_to_the_result(spark):
    rows = conversation_rows(random.Random(9), 30)
    docs = conversations.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    want = {r[0]: r[-1] for r in plain_repair(rows)}
    for kw in ({}, {"block_rows": 2}):
        turns = collections.defaultdict(list)
        for r in conversations.repaired_turns(docs, conversations.RepairParams(**kw)).collect():
            turns[r.conv_id].append((r.part, r.at, f"{r.role}:{r.text}"))
        assert {c: hashlib.sha256("\n".join(x for *_, x in sorted(turns[c])).encode()).hexdigest() for c in want} == want


def test_conversation_query(spark):
    from txnloom.llm.queries import QUERIES
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, QUERIES["op12_conversation_repair"](spark, SF).collect()), key=str) == plain_repair(rows)


def test_price_work_is_linear():
    p = conversations.RepairParams()
    layers = [conversations.row_layer(i % 4, "uas"[i % 3], p) for i in range(20_000)]
    price = conversations.auction([*layers, conversations.end_layer(p)], conversations.END)
    assert price[0][0] > 0 and len(conversations.trace([*layers, conversations.end_layer(p)], price, 0)[0]) >= 20_000
