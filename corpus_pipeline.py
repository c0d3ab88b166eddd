"""A training corpus in five stages: toxicity, near copies, repeated passages, mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns documents' columns; the last returns the digests of the
encoded and decoded texts. run() writes each stage's result to the shared folder and reads it again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chronocell.llm import bpe, mixing, neardup, suffixes, toxicity
from chronocell.llm.common import durable, release, scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
ORACLE_SQL = None  # a trained classifier and consistent weighted samples have no SQL form


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs.select(*COLUMNS))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixes.deduplicated(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs.select(*COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", drop_toxic), ("near copies", drop_near_copies), ("repeated passages", cut_repeats), ("mix", mix_sources), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage over the documents that the others leave; each stage's tables go once the next result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch():
            kept = durable(stage(spark, docs, sf_dir), name.replace(" ", "-"), stays=True)
        release(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
