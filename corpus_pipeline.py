"""A training corpus from ``documents``: five stages, each an operator of ``onomast.llm``.

A stage takes (spark, docs, sf_dir); what it returns is written as Parquet and read again as the docs of the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from onomast.llm import decontaminate, langid, packing, secrets, simhash
from onomast.llm.common import stored, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose language is unknown, or known with a probability under one half."""
    return langid.accepted(docs, langid.fit(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id stays."""
    return simhash.keep_one_each(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold benchmark content."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", known_language),
    ("simhash_dedup", one_of_each),
    ("decontamination", without_benchmarks),
    ("secret_scan", without_secrets),
    ("packing", packed),
]

#: A trained model, fingerprints, a random field and a tokenizer: not for SQL; tests hold it against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
