"""One query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cartage.llm import oracles
from cartage.llm.bpe import bpe_digests
from cartage.llm.compression import quality
from cartage.llm.langid import languages
from cartage.llm.maxent import lm_scores
from cartage.llm.merkle import merkle_proofs
from cartage.llm.minhash import near_duplicates
from cartage.llm.periodic import run_digests
from cartage.llm.projections import embedding_groups
from cartage.llm.secrets import secret_spans
from cartage.llm.spaced_seeds import contaminations
from cartage.llm.splitters import shards
from cartage.llm.toxicity import toxicity
from cartage.llm.url_ratio import judge_urls
from cartage.session import literal_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = dict(oracles.SQL)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(literal_path(f"{sf_dir}/{name}.parquet"))


@query
def op10_minhash(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"))


@query
def op9_splitters(spark, sf_dir):
    return shards(read(spark, sf_dir, "documents"))


@query
def op4_secrets(spark, sf_dir):
    return secret_spans(read(spark, sf_dir, "documents"))


@query
def op6_bpe(spark, sf_dir):
    return bpe_digests(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_language(spark, sf_dir):
    return languages(read(spark, sf_dir, "documents"))


@query
def op1_url_ratio(spark, sf_dir):
    return judge_urls(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query
def op2_spaced_seeds(spark, sf_dir):
    return contaminations(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op3_maxent(spark, sf_dir):
    return lm_scores(read(spark, sf_dir, "documents"))


@query
def op7_projections(spark, sf_dir):
    return embedding_groups(read(spark, sf_dir, "embeddings"))


@query
def op8_toxicity(spark, sf_dir):
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op11_compression(spark, sf_dir):
    return quality(read(spark, sf_dir, "documents"))


@query
def op12_merkle(spark, sf_dir):
    return merkle_proofs(read(spark, sf_dir, "documents"))


@query
def op13_periodic(spark, sf_dir):
    return run_digests(read(spark, sf_dir, "documents"))
