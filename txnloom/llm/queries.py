"""The queries of the thirteen operators, with SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(name: str, oracle: str | None = None):
    def add(plan):
        QUERIES[name] = plan
        if oracle:
            ORACLES[name] = oracle
        return plan
    return add


@_register("op1_quality_rules")
def _(spark, d):
    from .quality_rules import quality_verdicts
    got = quality_verdicts(table(spark, d, "documents"), table(spark, d, "labels"), keep=("doc_id",))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "rule")


@_register("op2_source_mixing", """
WITH d AS (SELECT doc_id, text, lang, source, n_chars, md5(coalesce(text, '')) AS text_md5,
    CASE WHEN regexp_matches(coalesce(text, ''), '[^\\x20\\x09-\\x0D]')
      THEN len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) ELSE 0 END AS words FROM documents),
s AS (SELECT source, CAST(sum(words) AS DOUBLE) AS have FROM d GROUP BY source),
w AS (SELECT source, have, sqrt(have) AS weight FROM s WHERE have > 0),
t AS (SELECT sum(have) AS have_all, list_reduce(list_prepend(CAST(0 AS DOUBLE), list(weight ORDER BY weight)), lambda a, b: a + b) AS weight_all FROM w),
r AS (SELECT source, have_all * (weight / weight_all) / have AS rate FROM w, t),
k AS (SELECT source, rate, CAST(ceil(rate + 12 * sqrt(rate) + 40) AS BIGINT) AS top FROM r),
l AS (SELECT source, i, sum(CASE WHEN i = 0 THEN 0 - rate ELSE ln(rate) - ln(CAST(i AS DOUBLE)) END)
    OVER (PARTITION BY source ORDER BY i) AS lp FROM (SELECT source, rate, unnest(range(0, top + 1)) AS i FROM k)),
c AS (SELECT source, i, sum(exp(lp)) OVER (PARTITION BY source ORDER BY i) AS cdf FROM l),
u AS (SELECT d.*, CAST('0x' || substr(md5('mix-17:' || coalesce(CAST(doc_id AS VARCHAR), '~') || ':' || text_md5), 1, 13) AS BIGINT) / 4503599627370496.0 AS u FROM d),
n AS (SELECT u.doc_id, u.text, u.lang, u.source, u.n_chars, text_md5,
    (SELECT count(*) FROM c WHERE c.source IS NOT DISTINCT FROM u.source AND c.cdf <= u.u) AS copies FROM u)
SELECT doc_id, text, lang, source, n_chars, copies AS n_copies, copy_no,
  md5('order-17:' || coalesce(CAST(doc_id AS VARCHAR), '~') || ':' || text_md5 || ':' || CAST(copy_no AS VARCHAR)) AS shuffle_key
FROM (SELECT *, unnest(range(1, copies + 1)) AS copy_no FROM n WHERE copies > 0)""")
def _(spark, d):
    from .mixing import mix_sources
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return mix_sources(docs)


@_register("op3_toxicity")
def _(spark, d):
    from .toxicity import ToxicParams, may_learn, score_toxicity, train
    docs = table(spark, d, "documents").select("doc_id", "text")
    p = ToxicParams()
    scored = score_toxicity(docs, train(docs, table(spark, d, "labels"), p), keep=("doc_id",))
    return scored.select("doc_id", (~may_learn()).alias("held_out"), F.col("toxic_score").alias("score"),
                         (F.col("toxic_score") >= p.threshold).cast("int").alias("predicted"))


@_register("op6_token_files")
def _(spark, d):
    from .token_files import read_tokens, token_folder, write_tokens
    folder = token_folder(spark)
    write_tokens(table(spark, d, "documents").select("doc_id", "text"), folder)
    return read_tokens(spark, folder)


@_register("op8_pieces")
def _(spark, d):
    from .sentencepieces import encode_pieces
    return encode_pieces(table(spark, d, "documents"))


@_register("op9_personal_data")
def _(spark, d):
    from .pii import personal_data
    return personal_data(table(spark, d, "documents"), keep=("doc_id",))


@_register("op5_near_duplicates")
def _(spark, d):
    from .neardup import near_duplicates
    return near_duplicates(table(spark, d, "documents"))


@_register("op7_lm_scoring")
def _(spark, d):
    from .lm_scoring import score_documents
    return score_documents(table(spark, d, "documents"))


@_register("op4_nearest", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
n AS (SELECT vec_id, v, sqrt(list_reduce(list_prepend(CAST(0 AS DOUBLE), list_transform(v, lambda x: x * x)), lambda a, b: a + b)) AS length FROM e),
s AS (SELECT q.vec_id AS query_id, c.vec_id, max(list_reduce(list_prepend(CAST(0 AS DOUBLE),
    list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])), lambda a, b: a + b) / (q.length * c.length)) AS score
  FROM n q JOIN n c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v) GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM s QUALIFY rank <= 5""")
def _(spark, d):
    from .neighbours import nearest
    return nearest(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0)


@_register("op10_cotraining")
def _(spark, d):
    from .cotraining import co_train, quality_scores
    docs = table(spark, d, "documents")
    return quality_scores(docs, co_train(docs, table(spark, d, "labels")))


@_register("op13_collocations", """
WITH w AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w FROM documents),
t AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM w GROUP BY lang),
s AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
g AS (SELECT lang, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, m, CAST(count(*) AS HUGEINT) AS f
  FROM s, (SELECT unnest(range(1, 6)) AS m) WHERE i + m - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, phrase, m, f, string_split(phrase, ' ') AS v, unnest(range(1, m)) AS k FROM g WHERE m > 1),
p AS (SELECT c.lang, c.phrase, c.m, c.f AS a, c.k, x.f AS l, y.f AS r, t.n, (1000 * c.f * t.n) // (x.f * y.f) AS score FROM c
  JOIN g x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(v, 1, k), ' ')
  JOIN g y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(v, k + 1, c.m), ' ') JOIN t ON t.lang = c.lang),
b AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
d AS (SELECT b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.lang = b.lang AND g.m > b.m AND 100 * g.f >= 100 * b.a
  AND contains(' ' || g.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM d QUALIFY rank <= 2000""")
def _(spark, d):
    from .phrases import collocations
    return collocations(table(spark, d, "documents"))


@_register("op11_license_scan")
def _(spark, d):
    from .license_scan import license_report
    return license_report(table(spark, d, "documents")).drop("spans")


@_register("op12_conversation_repair")
def _(spark, d):
    from .conversations import damaged, repair_conversations
    return repair_conversations(damaged(table(spark, d, "conversations")))
