"""Search, near-duplicates, scores, mixing and the pipeline against brute force."""

import collections
import functools
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check_oracle import differences
from txnloom.llm import components, lm_scoring, mixing, neardup, neighbours

SF = "/root/testdata/sf0.001"


# -- nearest ------------------------------------------------------------------

def brute_nearest(rows, k=5):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, x in good:
        if i % 50 == 0:
            best = out.setdefault(i, {})
            for j, y in good:
                if j != i and len(x) == len(y):
                    s = float(x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)))
                    best[j] = max(best.get(j, -2), s)
    return {i: sorted(((-round(s, 9), j) for j, s in b.items()))[:k] for i, b in out.items() if b}


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_nearest(spark, limit):
    rng = np.random.default_rng(1)
    rows = [(int(i), rng.normal(size=8).round(1).tolist()) for i in range(400)]
    rows += [(1000 + i, [1.0] * 8) for i in range(60)] + [(150, [0.5] * 8), (7, [1.0] * 8), (7, [1.0] * 8)]
    rows += [(None, [1.0] * 8), (2000, None), (2001, []), (2002, [0.0] * 8), (2003, [float("nan")] + [1.0] * 7), (2004, [None] + [1.0] * 7),
             (2050, [1.0, 2.0]), (2051, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3).withColumn("score", F.lit("x"))
    p = neighbours.BlockParams(block=64, query_block=4, broadcast_bytes=limit, open_blocks=2)
    got = collections.defaultdict(list)
    for r in neighbours.nearest(df, F.col("vec_id") % 50 == 0, p).orderBy("query_id", "rank").collect():
        got[r.query_id].append((-round(r.score, 9), r.vec_id))
    assert dict(got) == brute_nearest(rows)
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 50 == 0, p).count() == 0


def test_quantisation_bounds():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(50, 1500)), rng.normal(size=(60, 1500))
    (qa, sa, la, ea), (qb, sb, lb, eb) = neighbours.quantised(x), neighbours.quantised(y)
    near = neighbours.integer_products(qa, qb) * sa[:, None] * sb[None, :]
    true = (x / np.linalg.norm(x, axis=1)[:, None]) @ (y / np.linalg.norm(y, axis=1)[:, None]).T
    slack = ea[:, None] * lb[None, :] + la[:, None] * eb[None, :] + ea[:, None] * eb[None, :] + 1e-9
    assert (np.abs(near - true) <= slack).all() and slack.max() < 0.1


# -- near-duplicates ----------------------------------------------------------

def brute_groups(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        if i is not None:
            sets.setdefault(i, []).append({tuple(w)} if 0 < len(w) < 5 else {tuple(w[k:k + 5]) for k in range(len(w) - 4)})
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(sets, 2):
        if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in sets}


def copies(seed=3):
    random.seed(seed)
    word = lambda: "".join(random.choices("abcdefgh", k=4))
    rows, at = [], 0
    for group in (1, 1, 2, 5, 60):
        base = [word() for _ in range(120)]
        for _ in range(group):
            text = list(base)
            for _ in range(random.choice((0, 1, 2, 4, 6))):
                text[random.randrange(len(text))] = word()
            rows.append((at, " ".join(text)))
            at += 1
    rows += [(100, "Tiny Text"), (101, "tiny  text"), (102, "other"), (103, ""), (104, None), (105, " \n"), (None, rows[0][1]),
             (2, rows[2][1]), (106, rows[-1][1]), (107, "one two three four five"), (107, "six seven eight nine ten"), (108, "SIX seven eight nine ten")]
    return rows


def test_near_duplicates(spark):
    rows = copies()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component_id string").repartition(4)
    got = neardup.near_duplicates(df).collect()
    want = brute_groups(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == want.get(r.doc_id) and r.kept == (r.doc_id is None or r.doc_id == r.component_id), r
    one = neardup.keep_one_per_group(df).collect()
    assert sorted(r.doc_id for r in one if r.doc_id is not None) == sorted({c for c in want.values()})
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_crowded_regions_are_compared_in_full(spark):
    """Without neighbours and hubs the tiles alone find every link."""
    rows = [(i, t) for i, t in copies(5) if i is not None and i < 69]
    p = neardup.ForestParams(tile=8)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    reps = stored_reps(spark, df, p)
    label = spark.createDataFrame([], "node long, component long")
    pairs = {(r.a, r.b) for r in neardup.crowded_pairs(neardup.mixed_rows(neardup.tree_rows(reps, p), label), reps, label, p).collect()}
    sets = {i: set(neardup.shingle_set(t).tolist()) for i, t in rows}
    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] != sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            assert (a, b) in pairs


def test_hub_turns_leave_few_pairs_of_a_large_crowd(spark):
    """Edited copies of one text, most pairs below the similarity: groups as brute force, pairs of the last step few."""
    random.seed(11)
    word = lambda: "".join(random.choices("abcdefgh", k=4))
    base = [word() for _ in range(150)]
    rows = []
    for i in range(500):
        text = list(base)
        for k in random.sample(range(150), random.randint(2, 7)):
            text[k] = word()
        rows.append((i, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute_groups(rows)
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(df).collect()} == want
    p = neardup.ForestParams()
    from txnloom.llm.common import stored
    reps = stored(stored_reps(spark, df, p), "reps")
    crowd = stored(neardup.mixed_rows(neardup.tree_rows(reps, p), spark.createDataFrame([], "node long, component long")), "crowd")
    label, links = spark.createDataFrame([], "node long, component long"), None
    for turn in range(3):
        pairs = neardup.hub_pairs(crowd, reps, label, turn, p)
        assert pairs.count() <= p.hubs * len(rows)
        links = pairs if links is None else links.unionByName(pairs)
        label = stored(components.components(links), "label")
    assert neardup.crowded_pairs(crowd, reps, label, p).count() < 5 * len(rows)


def test_row_of_a_repeated_id_is_picked_by_content(spark):
    rows = [(1, f"text number {i} of one id", i) for i in range(30)]
    kept = {tuple(neardup.keep_one_per_group(spark.createDataFrame(random.sample(rows, 30), "doc_id long, text string, Text2 int").repartition(n)).collect()[0])
            for n in (1, 5)}
    assert len(kept) == 1


def test_no_text_moves_to_keep_one_per_group(spark):
    rows = [(i, "a b c d e f g h %d" % (i % 40)) for i in range(60)] + [(None, "x"), (None, "x"), (7, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = neardup.keep_one_per_group(df)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        few = neardup.keep_one_per_group(df, neardup.ForestParams(small_keys=0))
        # Only the rows of repeated ids are sorted out by their digests.
        assert plan.count("SortMergeJoin") == 1
        assert sorted(map(str, kept.collect())) == sorted(map(str, few.collect()))
        assert sum(r.doc_id is None for r in kept.collect()) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_text_meets_its_signature_once_for_all_trees(spark, monkeypatch):
    words = [f"w{k}" for k in range(200)]
    rows = [(i, " ".join(words[:k] + [f"x{i}"] + words[k + 1:])) for i, k in enumerate(range(10, 190, 9))]
    p = neardup.ForestParams()
    reps = stored_reps(spark, spark.createDataFrame(rows, "doc_id long, text string"), p)
    label, seen, kept = spark.createDataFrame([], "node long, component long"), [], neardup._in_tiles

    def watch(held, *rest):
        seen.append(held.count())
        return kept(held, *rest)
    monkeypatch.setattr(neardup, "_in_tiles", watch)
    crowd = neardup.mixed_rows(neardup.tree_rows(reps, p), label)
    assert neardup.crowded_pairs(crowd, reps, label, p).count() == len(rows) * (len(rows) - 1) // 2
    assert seen == [len(rows)] and crowd.count() > 5 * len(rows)


def test_chains_within_a_block_take_no_round(spark, monkeypatch):
    chain = spark.createDataFrame([(i, i + 1) for i in range(400)], "a long, b long")
    labels, kept = [], components.stored
    monkeypatch.setattr(components, "stored", lambda df, label: labels.append(label) or kept(df, label))
    assert {r.component for r in components.components(chain).collect()} == {0} and "large" not in labels
    assert {r.component for r in components.components(chain, block=50).collect()} == {0} and "large" in labels


def stored_reps(spark, df, p):
    return neardup.described(df, p).where("cls is not null").select(F.col("doc_id").alias("rep"), "n", "sig")


def test_components(spark):
    random.seed(8)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(80)]
    edges += [(5000, 6000 + i) for i in range(50)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- language model -----------------------------------------------------------

def brute_tree(train, texts, depth):
    count, kids = collections.defaultdict(lambda: [0, 0]), collections.defaultdict(set)

    def steps(s):
        x = lm_scoring.END * depth + s
        for k in range(depth, len(x)):
            for j in range(8):
                yield x[k - depth:k][::-1], (1 << j) | (x[k] >> (8 - j)), (x[k] >> (7 - j)) & 1
    for s in train:
        for context, node, bit in steps(s):
            for m in range(depth + 1):
                count[context[:m], node][bit] += 1
                if m < depth:
                    kids[context[:m], node].add(context[:m + 1])
    kt = lambda a, b: math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1)

    @functools.lru_cache(None)
    def log_pw(c, node):
        own = kt(*count.get((c, node), (0, 0)))
        return own if len(c) == depth else math.log(.5) + np.logaddexp(own, sum(log_pw(k, node) for k in kids.get((c, node), ())))

    def mixed(c, node, bit, context):
        z, o = count.get((c, node), (0, 0))
        own = ((o if bit else z) + .5) / (z + o + 1)
        if len(c) == depth:
            return own
        stay = math.exp(math.log(.5) + kt(z, o) - log_pw(c, node))
        return stay * own + (1 - stay) * mixed(context[:len(c) + 1], node, bit, context)
    return [sum(math.log10(mixed(b"", node, bit, context)) for context, node, bit in steps(s)) for s in texts]


@pytest.mark.parametrize("depth,chunk", [(2, 1 << 20), (4, 500)])
def test_context_tree(spark, depth, chunk):
    some = [r.text[:200] for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(20).collect()]
    rows = [*enumerate(some), (100, None), (101, ""), (102, "É x \n"), (None, "hello"), (7, "a")]
    df = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double")
    got = lm_scoring.score_documents(df, lm_scoring.ContextParams(depth, chunk, 3)).collect()
    train = [lm_scoring.normal_bytes(t) for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    want = brute_tree(train, [lm_scoring.normal_bytes(t) for _, t in rows], depth)
    assert np.allclose(sorted(r.score for r in got), sorted(want), rtol=1e-6, atol=1e-5)
    c = collections.Counter(w for s in train for w in [*s.split(), lm_scoring.END])
    n, v = sum(c.values()), len(c)
    by_text = collections.Counter()
    for i, t in rows:
        words = [*lm_scoring.normal_bytes(t).split(), lm_scoring.END]
        by_text[i, len(words), sum(c[w] > 0 for w in words), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words), 8)] += 1
    assert by_text == collections.Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 8)) for r in got)
    assert lm_scoring.score_documents(df.limit(0)).count() == 0


def test_no_group_holds_all_lists_of_a_context(spark, monkeypatch):
    # One context before every word, and a chunk for each text.
    rows = [(i, ". a" + chr(97 + i % 26) + ". b" * (i % 5)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen, kept = [], lm_scoring.part_answers

    def watch(needs, models, buckets):
        seen.append((buckets, max(r["count"] for r in needs.groupBy("kind", "part", "bucket").count().collect())))
        return kept(needs, models, buckets)
    monkeypatch.setattr(lm_scoring, "part_answers", watch)
    monkeypatch.setattr(lm_scoring, "FAN_IN", 3)
    got = lm_scoring.score_documents(df, lm_scoring.ContextParams(4, 1, 5, bucket_chunks=4)).collect()
    assert seen[0][0] == 15 and seen[0][1] < 20
    train = [lm_scoring.normal_bytes(t) for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    want = brute_tree(train, [lm_scoring.normal_bytes(t) for _, t in rows], 4)
    assert np.allclose([r.score for r in sorted(got, key=lambda r: r.doc_id)], want, rtol=1e-6, atol=1e-5)
    # Contexts that share their two nearest bytes are dealt to different parts.
    grams = np.array([(ord(" ") << 32) | (ord(".") << 24) | (c << 16) for c in range(97, 123)], np.uint64)
    assert len(np.unique(lm_scoring.gram_parts(grams, 4, 50))) > 10


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 2, 9.99, 10, 1e3, 1e9])
    assert np.allclose(lm_scoring.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-12)


# -- mixing -------------------------------------------------------------------

def test_mixing_reaches_the_weights(spark):
    rows = [(i, "a b c d", "big" if i % 3 else None) for i in range(6000)] + [(7000, "", "void"), (None, "x y", "big")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copy_no", F.lit(-1))
    for small in (10_000, 0):
        got = mixing.mix_sources(df, small_sources=small)
        share = {r.source: r.n for r in got.groupBy("source").agg(F.count("*").alias("n")).collect()}
        assert "void" not in share and abs(share["big"] / share[None] - math.sqrt(2)) < 0.12
        assert abs(sum(share.values()) - 6000) < 300
    assert [r.copy_no for r in got.where("n_copies = 3").select("doc_id", "copy_no").orderBy("doc_id", "copy_no").limit(3).collect()] == [1, 2, 3]
    named = mixing.mix_sources(df, weights={"big": 1.0}).select("source").distinct().collect()
    assert [r.source for r in named] == ["big"]
    assert mixing.mix_sources(df.limit(0)).count() == 0


def test_large_rates_do_not_underflow(spark):
    steps = spark.range(1).select(mixing.poisson_steps(F.lit(900.0)).alias("s")).first().s
    assert abs(steps[-1] - 1) < 1e-9 and abs(next(k for k, v in enumerate(steps) if v > 0.5) - 900) <= 1


def test_queries_equal_their_sql(spark):
    assert set(differences(spark, SF).values()) == {None}


# -- pipeline -----------------------------------------------------------------

def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before, kept = kept, stage(spark, kept, SF)
        kept.write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        if name != "pieces":
            assert kept.columns == docs.columns
        if name == "near_duplicates":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute_groups(rows).values()))
        if name == "personal_data":
            assert kept.count() == before.count() and kept.where("text rlike '@mail[0-9].example.com'").count() == 0
    assert kept.where("NOT round_trip").count() == 0 and kept.count() > 0


def test_pipeline_of_nothing(spark, tmp_path):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_common_sizes():
    rng = np.random.default_rng(1)
    sets = np.empty(12, object)
    for k in range(12):
        sets[k] = np.unique(rng.integers(-40, 40, rng.integers(1, 60)))
    i, j = (x.ravel() for x in np.meshgrid(np.arange(12), np.arange(12)))
    keep = rng.random(len(i)) < 0.6
    i, j = i[keep], j[keep]
    assert neardup._common(i, j, sets).tolist() == [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)]
    assert len(neardup._common(i[:0], j[:0], sets)) == 0


def test_objects_of_sliced_lists():
    import pyarrow as pa
    lists = pa.array([[1], [2, 3], [], [4, 5, 6]], pa.list_(pa.int64())).slice(1)
    assert [x.tolist() for x in neardup._objects(lists)] == [[2, 3], [], [4, 5, 6]]
    assert neardup._objects(pa.array([b"a", b"bc"])).tolist() == [b"a", b"bc"]
