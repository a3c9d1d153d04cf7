"""A corpus pipeline: language ID, near-dedup, decontamination, secret masking, BPE digests.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read back as the next one's ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartage.functions.types import quoted
from cartage.llm.bpe import bpe_digests
from cartage.llm.langid import identified
from cartage.llm.minhash import near_duplicates
from cartage.llm.secrets import without_secrets
from cartage.llm.spaced_seeds import decontaminated
from cartage.session import literal_path, materialize, scratch

# no SQL: the first stage is a trained model, the last a tokenizer; tests hold each stage against a plain version
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(literal_path(f"{sf_dir}/{name}.parquet"))


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough confidence. Null, letterless and rejected texts go."""
    return identified(docs)


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates; of rows that repeat an id, one stays.

    Only ids move for the decision; the documents join it by hash of their id. Rows without an id stay, and so do
    texts without words; an empty table gives an empty result.
    """
    groups = materialize(near_duplicates(docs), scratch(spark, "kept-copies"))
    dropped = groups.where(~F.col("kept")).select("doc_id").distinct()
    repeated = groups.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    # always by hash: the dropped ids grow with the documents, so broadcasting them would not last
    rest = docs.join(dropped.hint("merge"), "doc_id", "left_anti").select(docs.columns)
    if repeated.isEmpty():
        return rest
    # rows that share an id are one document, whose first row in order stays; combined per task, however many there are
    columns = [F.col(quoted(c)) for c in docs.columns if c != "doc_id"]
    firsts = rest.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*columns)).alias("row"))
    several = firsts.select("doc_id", "row.*")
    return rest.join(repeated, "doc_id", "left_anti").select(docs.columns).unionByName(several)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark.

    Null and empty texts hold none, rows without an id stay, rows that repeat each other go or stay together; an
    empty table, or an empty benchmark, changes nothing.
    """
    return decontaminated(docs, _table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mask, ``n_chars`` told anew where that happened.

    Null and empty texts pass as they are, repeated rows are masked alike; an empty table gives an empty result.
    """
    return without_secrets(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts, a row per document.

    A null text is encoded as the empty one, null ids pass, repeated rows give equal rows; an empty table gives an
    empty result.
    """
    return bpe_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", keep_identified),
    ("near_dedup", keep_first_copies),
    ("decontamination", keep_uncontaminated),
    ("secret_scan", mask_secrets),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), scratch(spark, f"pipeline-{name}"))
    return STAGES[-1][1](spark, docs, sf_dir)
