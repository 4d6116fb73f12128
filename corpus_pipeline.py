"""Corpus pipeline: quality rules, near-duplicate removal, personal data, mixing, tokens.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet in the shared folder and read again as the next one's ``docs``.  All stages but the last return the columns of
``documents``.  ``ORACLE_SQL`` is None: the learned spans and the mix's hashed keys have no SQL form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.llm import bpe, jaccard, mixing, pii, quality
from linkweave.llm.common import table
from linkweave.llm.queries import tokenizer_path
from linkweave.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.passing(docs)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles are linked at 0.8."""
    return jaccard.one_of_each(docs, percent=80, width=5)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; ``n_chars`` follows the text."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken."""
    return mixing.mixed_documents(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids' number and digest, and the decoded text's digest, of each document of the mix."""
    return bpe.encode_documents(docs, tokenizer_path(), ("n_tokens", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("PII", pii_stage),
    ("mixing sources to target weights", mixing_stage),
    ("BPE encoding and decoding", bpe_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{n}")
    return docs
