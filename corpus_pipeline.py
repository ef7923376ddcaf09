"""The corpus pipeline: stages over the table of documents, each written and read again.

All stages but the last return the columns of their input; further columns, whatever their names, go along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from palisade.llm.langid import with_known_language
from palisade.llm.leaks import without_leaks
from palisade.llm.mixing import mixed_rows
from palisade.llm.near import keep_one_of_each
from palisade.llm.tables import Workspace, documents
from palisade.llm.tokenfiles import token_digest

TOKENIZER = "byte_bpe_50k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose text the network finds in no language: null, without a letter, or a low score.

    Equal texts share a verdict, so repeated rows stay or go together.  No rows give no rows.
    """
    Workspace(spark, "pipeline-language")  # settings of the session
    return with_known_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest doc_id (null first; among equals the least text).

    Null and empty texts are near no other and stay.  No rows give no rows.
    """
    return keep_one_of_each(docs, Workspace(spark, "pipeline-near"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in which a passage of the benchmark occurs; null and empty texts hold none.

    Each row of a repeated id is judged by its own text.  No rows, or no benchmark items, change nothing.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return without_leaks(docs, benchmark, Workspace(spark, "pipeline-leaks"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: up to twice, or not at all; a null source is a source of its own.

    Null and empty texts have size 0 and no share.  Repeated rows are taken each by itself.  No rows give no rows.
    """
    return mixed_rows(docs, Workspace(spark, "pipeline-mix"))


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and one row per document in them: doc_id, start, n_tokens, ids_crc32, shard.

    A null or empty text is the end token alone; a repeated row is written as often as it comes.
    """
    return token_digest(docs, Workspace(spark, "pipeline-tokens"), public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("token_files", token_files),
]
ORACLE_SQL = None  # the mix follows a hash and the tokens a tokenizer; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents."""
    workspace = Workspace(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = workspace.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
