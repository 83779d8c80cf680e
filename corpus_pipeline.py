"""From raw documents to token ids: toxicity, near-duplicates, personal data, mixing, pieces.

Every stage takes all rows that the one before it kept. ``run`` writes each stage's rows to the shared
folder before the next one reads them, so no stage is computed twice and a lost executor costs one task.

Defined cases: rows with NULL ids or texts pass all filters (an empty text is not toxic and in no group);
of rows that share an id, near-duplicates keep one; an empty table gives an empty result. Stages return
the columns of ``documents`` (all columns of their input), the last one token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnloom.llm.common import stored, table
from txnloom.llm.mixing import ADDED, mix_sources
from txnloom.llm.neardup import keep_one_per_group
from txnloom.llm.pii import mask_personal_data
from txnloom.llm.sentencepieces import encode_pieces
from txnloom.llm.toxicity import ToxicParams, score_toxicity, train


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold; the model is trained on this input and ``labels``."""
    p = ToxicParams()
    scored = score_toxicity(docs, train(docs, table(spark, sf_dir, "labels"), p))
    return scored.where(F.col("toxic_score") < p.threshold).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return keep_one_per_group(docs)


def mask_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; ``n_chars`` follows the text."""
    masked = mask_personal_data(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else masked


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources have their target shares, in a global random order."""
    return mix_sources(docs.drop(*[c for c in docs.columns if c in ADDED])).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every copy."""
    return encode_pieces(docs, keep=("doc_id", "source"))


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("personal_data", mask_private),
          ("mixing", mix), ("pieces", encode)]

#: Learned classifiers and similarity groups have no SQL form; the stages are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
