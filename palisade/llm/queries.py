"""The operators as queries over the given tables, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from palisade.llm.dialogues import REPAIR_SQL, repair_digest
from palisade.llm.exact import exact_duplicates
from palisade.llm.hmm import score_texts
from palisade.llm.langid import language_digest
from palisade.llm.leaks import LEAKS_SQL, leaks_digest
from palisade.llm.mixing import mix_digest
from palisade.llm.near import near_digest
from palisade.llm.negatives import NEGATIVES_SQL, negatives_digest
from palisade.llm.pii import fit_tagger, pii_digest
from palisade.llm.repeats import repeats_digest
from palisade.llm.secrets import secrets_digest, secrets_sql
from palisade.llm.simhash import simhash_digest
from palisade.llm.tables import Workspace, documents
from palisade.llm.tokenfiles import token_digest

TOKENIZER = "byte_bpe_50k.json"  # a file of the public tokenizers; other paths are a parameter of the operator

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            TWINS[name] = sql
        return fn

    return register


@_query(
    "op9_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
      doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
)
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir), Workspace(spark, "op9"))


@_query("op7_secret_scan", secrets_sql())
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_digest(documents(spark, sf_dir), Workspace(spark, "op7"))


@_query("op8_decontaminate", LEAKS_SQL)
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return leaks_digest(documents(spark, sf_dir), benchmark, Workspace(spark, "op8"))


@_query("op3_token_files")
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(documents(spark, sf_dir), Workspace(spark, "op3"), public_tokenizers.path(TOKENIZER))


@_query("op10_mix_sources")
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_digest(documents(spark, sf_dir), Workspace(spark, "op10"))


@_query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_digest(documents(spark, sf_dir))


@_query("op2_hmm_scores")
def op2_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(documents(spark, sf_dir), Workspace(spark, "op2"))


@_query("op1_pii")
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    workspace = Workspace(spark, "op1")
    return pii_digest(docs, fit_tagger(docs, workspace))


@_query("op6_near_dedup")
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_digest(documents(spark, sf_dir), Workspace(spark, "op6"))


@_query("op5_repeated_passages")
def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_digest(documents(spark, sf_dir), Workspace(spark, "op5"))


@_query("op13_hard_negatives", NEGATIVES_SQL)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives_digest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), Workspace(spark, "op13"))


@_query("op12_simhash")
def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_digest(documents(spark, sf_dir), Workspace(spark, "op12"))


@_query("op11_conversation_repair", REPAIR_SQL)
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_digest(spark.read.parquet(f"{sf_dir}/conversations.parquet"), Workspace(spark, "op11"))
