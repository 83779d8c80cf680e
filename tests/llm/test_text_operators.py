"""The operators on single texts against plain Python, with the odd cases each docstring defines."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from txnloom.llm import cotraining, pii, quality_rules, sentencepieces, token_files, toxicity
from txnloom.llm.common import stored

SF = "/root/testdata/sf0.001"
ODD = [None, "", " \n\t ", "a", "a a a a a", "x" * 20_000, "é ü 日本 \U0001f600", "one\n\none\none two", "\n\n \n", "a  b   c \n  d "]


def rows_of(spark, texts=ODD, ids=None):
    ids = ids or [None, *range(len(texts) - 1)]
    return spark.createDataFrame(list(zip(ids, texts, ["s"] * len(texts), ["x"] * len(texts))), "doc_id long, text string, source string, kept string")


def no_rows(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string, n_chars long")


# -- quality rules ------------------------------------------------------------

def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(inside))


def test_counts(spark):
    random.seed(1)
    texts = ODD[:5] + ODD[6:] + ["".join(random.choice("ab \n#|") for _ in range(random.randint(0, 60))) for _ in range(300)]
    assert [quality_rules.count_text(t)[:5] for t in texts] == [plain_counts(t) for t in texts]
    got = quality_rules.text_statistics(rows_of(spark)).collect()
    assert [tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for r in got] == [
        quality_rules.count_text(t)[:5] for t in ODD]
    assert quality_rules.text_statistics(no_rows(spark)).count() == 0


def test_rules_cover_what_was_planted(spark):
    rng = np.random.default_rng(3)
    x = rng.random((4000, 3))
    bad = ((x[:, 0] > 0.8) & (x[:, 1] < 0.5)) | (x[:, 2] > 0.95)
    rules = quality_rules.learn_rules(x, bad, ["words", "symbols", "upper"], rng.random(4000) < 0.66)
    hit = np.zeros(4000, bool)
    for r in rules:
        hit |= quality_rules._holds(x, ["words", "symbols", "upper"], r.terms)
    assert (hit & bad).sum() > 0.9 * bad.sum() and (hit & ~bad).sum() < 0.03 * bad.sum()
    assert quality_rules.learn_rules(x, np.zeros(4000, bool), ["a", "b", "c"], np.ones(4000, bool)) == []


def test_verdicts_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = quality_rules.quality_verdicts(rows_of(spark), labels, keep=("doc_id",)).collect()
    assert len(got) == len(ODD) and all(r.rule is None and r.base_failed and not r.kept for r in got)


# -- toxicity -----------------------------------------------------------------

def test_toxicity_on_held_out_rows(spark):
    random.seed(2)
    calm = "the of and to in that it is was for on are as with his they at be this have".split()
    rude = ["idiot", "moron", "scum", "gribbler"]
    docs, labels = [], []
    for i in range(900):
        words = random.choices(calm, k=40)
        bad = i % 5 == 0
        if bad:
            words[::8] = random.choices(rude, k=5)
        docs.append((i, " ".join(words), "s"))
        labels.append((i, int(bad)))
    df = spark.createDataFrame(docs + [(None, None, "s"), (1000, "", "s")], "doc_id long, text string, toxic_score string")
    model = toxicity.train(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r.toxic_score for r in toxicity.score_toxicity(df, model, keep=("doc_id", "toxic_score")).collect()}
    truth = dict(labels)
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([(got[i] >= 0.7) == bool(truth[i]) for i in held]) > 0.98
    assert got[None] == got[1000] < 0.5 and len(got) == 902


def test_label_model_finds_accuracies_and_repeats():
    rng = np.random.default_rng(5)
    y = rng.random(40_000) < 0.2
    fires = [(0.8, 0.02), (0.6, 0.05), (0.5, 0.01), (0.7, 0.1)]
    votes = np.stack([np.where(y, rng.random(len(y)) < a, rng.random(len(y)) < b) for a, b in fires] + [None] * 0, 1).astype(float)
    votes = np.column_stack([votes, votes[:, 0]])  # the last voter repeats the first
    delta, correlation, ratio = toxicity.label_model(len(y), votes.T @ votes, 0.2)
    assert np.allclose(delta[1:4], [a - b for a, b in fires[1:]], atol=0.12)
    assert correlation[0, 4] > 0.5 and correlation[1, 2] < 0.1
    assert toxicity.vote_logit([0, 4], ratio, correlation) < 1.5 * toxicity.vote_logit([0], ratio, correlation)


def test_toxicity_without_toxic_labels(spark):
    docs = spark.createDataFrame([(1, "you idiot, you scum"), (2, "a fine day")], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(2, 0)], "doc_id long, toxic int"))
    got = {r.doc_id: r.toxic_score for r in toxicity.score_toxicity(docs, model).collect()}
    assert got[1] > 0.7 > 0.3 > got[2]


# -- token files --------------------------------------------------------------

def test_token_files_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(token_files.tokenizer_path())
    tok.encode_special_tokens = True
    random.seed(4)
    texts = ODD + ["".join(random.choice("ab \n\t'.<|endoftext|>é") for _ in range(random.randint(0, 50))) for _ in range(150)]
    ids = [None, *random.sample(range(-50, 500), len(texts) - 3), 900, 900]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(3)
    folder = str(tmp_path / "t")
    token_files.write_tokens(df, folder, token_files.TokenParams(shard_bytes=300))
    got = sorted(token_files.read_tokens(spark, folder, with_ids=True).collect(), key=lambda r: r.start)
    want = collections.Counter((i, *tok.encode(t or "", add_special_tokens=False).ids, 2) for i, t in zip(ids, texts))
    assert collections.Counter((r.doc_id, *r.ids) for r in got) == want
    assert [r.start for r in got] == [0, *itertools.accumulate(r.n_tokens for r in got)][:-1]
    known = [r.doc_id for r in got if r.doc_id is not None]
    assert known == sorted(known) and got[0].doc_id is None
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)
    one = next(i for i in ids if i not in (None, 900))
    assert [(one, *x) in want for x in token_files.read_document(spark, folder, one)] == [True]
    assert len(token_files.read_document(spark, folder, 900)) == 2 and token_files.read_document(spark, folder, 10_000) == []


def test_added_tokens_are_those_of_the_file(spark, tmp_path):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(token_files.tokenizer_path())
    random.seed(6)
    parts = ["<|endoftext|>", " ", "  ", "\n", "end", "of", "<|", "é", "."]
    texts = ["end <|endoftext|> of", "<|endoftext|>", "a<|endoftext|>", "<|endoftext|> <|endoftext|>", "no token <|endoftext |>"]
    texts += ["".join(random.choices(parts, k=random.randint(0, 12))) for _ in range(150)]
    token_files.write_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), str(tmp_path / "t"))
    got = {r.doc_id: r.ids for r in token_files.read_tokens(spark, str(tmp_path / "t"), with_ids=True).collect()}
    assert got == {i: [*tok.encode(t, add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}


def test_dictionary_is_trained_on_whole_short_documents(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    text = lambda k: " ".join(rng.choices(words, k=k))
    short, long = [(i, text(400)) for i in range(60)], [(i, text(9_000)) for i in range(60, 100)]
    train = lambda rows: token_files.train_dictionary(
        spark.createDataFrame(rows, "doc_id long, text string"), token_files.TokenParams(), token_files.tokenizer_path(), 2)
    assert train(short + long) == train(short) != b""
    assert train(long) == b""


def test_token_files_of_nothing(spark, tmp_path):
    token_files.write_tokens(no_rows(spark), str(tmp_path / "n"))
    assert token_files.read_tokens(spark, str(tmp_path / "n")).count() == 0


# -- pieces -------------------------------------------------------------------

@pytest.fixture(scope="module")
def pieces():
    return sentencepieces.Pieces(sentencepieces.model_path())


def whole_search(p, text):
    """Best score over all segmentations, without a window."""
    best = [0.0] + [-float("inf")] * len(text)
    for i in range(len(text)):
        node, single = p.trie, False
        for j in range(i, len(text)):
            node = node.get(text[j])
            if node is None:
                break
            if "" in node:
                best[j + 1] = max(best[j + 1], best[i] + node[""][0])
                single |= j == i
        if not single:
            best[i + 1] = max(best[i + 1], best[i] + p.low)
    return best[-1]


def score_of(p, text, ids):
    by_id = {}
    def walk(node):
        for k, v in node.items():
            if k == "":
                by_id[v[1]] = v[0]
            else:
                walk(v)
    walk(p.trie)
    total = sum(by_id[i] for i in ids if i in by_id)
    return total + p.low * sum(1 for ch in text if ch not in p.trie or "" not in p.trie[ch] and False)


def test_streaming_search_is_the_whole_search(pieces):
    random.seed(6)
    for _ in range(200):
        text = sentencepieces.MARK + "".join(random.choice("theand ▁ing.é") for _ in range(random.randint(1, 300))).replace(" ", "▁")
        search = sentencepieces.StreamingViterbi(pieces, check_every=16)
        cut = random.randint(0, len(text))
        ids = search.feed(text[:cut]) + search.feed(text[cut:]) + search.finish()
        assert ids == sentencepieces.encode_stream(pieces, text)
        assert not search.text or len(search.ids) == 0
        assert abs(score_of(pieces, text, ids) - whole_search(pieces, text)) < 1e-3 * abs(whole_search(pieces, text))


def test_runs_that_never_meet_take_linear_time(pieces):
    import time
    for text in ("-" * 5_000, "=-" * 3_000, sentencepieces.MARK * 5_000, "ab" * 4_000):
        assert abs(score_of(pieces, text, sentencepieces.encode_stream(pieces, text)) - whole_search(pieces, text)) < 1e-6 * len(text) * 20
    seconds = []
    for n in (100_000, 400_000):
        start = time.perf_counter()
        ids = sentencepieces.encode_stream(pieces, "-" * n)
        seconds.append(time.perf_counter() - start)
        assert b"".join(pieces.output[i] for i in ids) == b"-" * n
    # Four times the text: a quadratic search would take sixteen times as long.
    assert seconds[1] < 8 * seconds[0] + 0.5


def test_ordinary_text_keeps_a_short_window(pieces):
    text = sentencepieces.MARK + sentencepieces.MARK.join(["the", "window", "stays", "short"] * 2_000)
    search = sentencepieces.StreamingViterbi(pieces)
    kept = 0
    for k in range(0, len(text), 1_000):
        search.feed(text[k:k + 1_000])
        kept = max(kept, len(search.text))
    assert kept < 400


def test_pieces_round_trip(spark):
    df = rows_of(spark)
    got = sentencepieces.encode_pieces(df, keep=("doc_id", "text")).collect()
    assert len(got) == len(ODD) and all(r.round_trip for r in got)
    back = {r.doc_id: r.text for r in sentencepieces.decode_pieces(sentencepieces.encode_pieces(df)).collect()}
    assert back == {i: t or "" for i, t in zip([None, *range(len(ODD) - 1)], ODD)}
    assert sentencepieces.encode_pieces(no_rows(spark)).count() == 0


def test_chunks_equal_whole_texts(pieces):
    _, encoder = sentencepieces.piece_encoder(sentencepieces.model_path())
    texts = [t for t in ODD if t] + ["▁a ▁ b", " lead", "tail "]
    got = encoder.encode(pa.array(texts))
    for t, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == sentencepieces.encode_stream(pieces, "▁" + t.replace(" ", "▁"))


# -- personal data ------------------------------------------------------------

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = "".join(re.findall("[0-9]", m.group()))
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else True,
                  "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), k, m.end()))
    return [(a, pii.BASE_KINDS[k], b) for a, k, b in sorted(out)]


def test_patterns_equal_plain_search():
    random.seed(7)
    for _ in range(5000):
        text = "".join(random.choice("a1.2@+- ()9%45é") for _ in range(random.randint(0, 40)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.base_spans("9" * 50_000 + "." + "a" * 50_000) == []


def test_field_on_sentences_it_has_not_seen():
    field = pii.train_field()
    for words, tags in pii.labelled_sequences():
        assert [pii.TAGS[t] for t in pii.viterbi(field, [field.emissions(words)])[0]] == tags
    unseen = {"please call [555-0163] today": "phone", 'token = "[0a4d55a8d778e5022fab701977c5d840bbc486d0]" and': "secret",
              "her ssn is [219-45-7788] on file": "ssn"}
    for text, kind in unseen.items():
        start, end = text.index("["), text.index("]") - 1
        _, every = pii.find_spans([text.replace("[", "").replace("]", "")], field)
        assert (start, kind, end) in every[0], (text, every)
    for calm in ("version 2.0 of 12 parts", "they met in 1987 at 10:30", "order number 4412473014894483 has left", "a b c"):
        assert pii.find_spans([calm], field)[1] == [[]]


def test_personal_data_of_odd_rows(spark):
    got = pii.personal_data(rows_of(spark, [*ODD[:-1], "me@x.org +1 (974) 555-3436"]), keep=("doc_id",)).collect()
    assert [(r.n_email, r.n_phone) for r in got] == [(0, 0)] * (len(ODD) - 1) + [(1, 1)]
    masked = pii.mask_personal_data(rows_of(spark, ["mail me@x.org now", None], [1, 2]))
    assert masked.columns == ["doc_id", "text", "source", "kept"]
    assert [r.text for r in masked.collect()] == ["mail [EMAIL] now", None]
    assert pii.personal_data(no_rows(spark)).count() == 0


# -- co-training --------------------------------------------------------------

def test_cotraining_on_rows_without_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen = labels.where("doc_id % 4 <> 0")
    model = cotraining.co_train(docs, seen)
    got = cotraining.quality_scores(docs, model).join(labels.where("doc_id % 4 = 0"), "doc_id").collect()
    assert len(got) > 50 and np.mean([r.kept == (r.quality == 1) for r in got]) > 0.93


def test_all_unlabelled_rows_take_part_in_cotraining(spark):
    # Texts tell the labelled rows apart; a source that labels never saw is learnt from unlabelled rows alone.
    n, rng = 26_000, random.Random(8)
    # The rare source has the rows that a sample of the smallest hashes would reach last.
    last = {r.id for r in spark.range(400, n).orderBy(F.xxhash64(F.lit("sample"), F.col("id").cast("string")).desc()).limit(40).collect()}
    docs, labels = [], []
    for i in range(n):
        is_good = i % 2 == 0
        source = "seen" if i < 400 else "rare" if i in last else "common"
        words = rng.choices("the of and to in that it is was for".split(), k=30) if is_good or source == "common" else ["BUY!!!", "$$$"] * 15
        docs.append((i, " ".join(words), source if source != "rare" else ("rare-good" if is_good else "rare-bad")))
        if i < 400:
            labels.append((i, int(is_good)))
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(4)
    p = cotraining.CoParams(exchanged=13_000, rounds=1)
    model = cotraining.co_train(df, spark.createDataFrame(labels, "doc_id long, quality int"), p)
    slots = {s: cotraining.page_slots(s, None, None, None, p) for s in ("rare-good", "rare-bad")}
    used = [model.page.weights[x].sum() for x in slots.values()]
    assert used[0] > used[1] + 0.5
    # Every unlabelled row of the rare source is scored, and the surest come first whatever the partitions.
    again = cotraining.co_train(df.repartition(7), spark.createDataFrame(labels, "doc_id long, quality int"), p)
    assert np.allclose(model.page.weights, again.page.weights, atol=1e-9)


def test_bins_come_from_all_values():
    x = np.sort(cotraining.coarse(np.random.default_rng(2).random(5_000)))
    cuts = cotraining.cuts_of(*np.unique(x, return_counts=True), 10)
    assert np.allclose(cuts, np.linspace(0.1, 0.9, 9), atol=0.02)


def test_cotraining_of_odd_rows(spark):
    df = rows_of(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = cotraining.co_train(df, none)
    got = cotraining.quality_scores(df, model, keep=("doc_id", "kept")).collect()
    assert len(got) == len(ODD) and {r.quality_score for r in got} == {0.5}
    assert cotraining.quality_scores(no_rows(spark), model).count() == 0


def test_stored_rows_come_back(spark):
    df = spark.range(10).selectExpr("id", "cast(null as string) AS t")
    assert sorted(stored(df, "x").collect()) == sorted(df.collect())
