"""Corpus preparation in five stages, each written as Parquet and reread by the next.

Language ID, exact dedup, near-dedup, mixing sources to target weights, BPE
encoding. Every stage works on all rows that its predecessor kept; the
first four return the columns of ``documents``, the last adds token ids.
Columns beyond those of ``documents`` in the input are left out; null
texts count as empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dbtelemetry import ship_to_executors
from dbtelemetry.llm import bpe, common, exact_dedup, langid, minhash_dedup, mixing

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Below this posterior probability the language of a text counts as not told.
MIN_LANGUAGE_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters and those whose best language has a probability below one half."""
    ship_to_executors(spark)
    docs = docs.select(*COLUMNS)
    model = langid.train(docs, common.remainder("doc_id", 4) != 2)
    scored = langid.with_language(docs, model, "text", "_lang_pred", "_score")
    keep = (F.col("_lang_pred") != langid.UNKNOWN) & (F.col("_score") >= MIN_LANGUAGE_SCORE)
    return scored.filter(keep).select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of equal texts the row with the largest doc_id."""
    ship_to_executors(spark)
    return exact_dedup.winners(docs.select(*COLUMNS))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the smallest doc_id of each near-duplicate class."""
    ship_to_executors(spark)
    return minhash_dedup.kept_rows(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequence: documents in the order of their positions, once for each time the mix takes them."""
    ship_to_executors(spark)
    return mixing.sequence(docs.select(*COLUMNS), payload=COLUMNS).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and the digest of the text that they decode to."""
    ship_to_executors(spark)
    out = bpe.with_ids(docs.select(*COLUMNS), decoded=True)
    return out.select("doc_id", "lang", "source", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Trained models, similarity classes and BPE have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; intermediate tables go to the shared folder."""
    docs = common.table(spark, sf_dir, "documents")
    root = f"{common.shared_dir(spark)}/pipeline/{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{root}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
