"""Training-data pipeline over `documents`.

Stages, in order: quality rules drop what they reject; of every group of SimHash
near-duplicates one document stays; passages of `benchmark` are cut out, and
documents that are mostly such passages dropped; secrets are masked; the rest is
encoded into the SentencePiece ids of its best segmentation, beside the scores of
the ``N_BEST`` best and the ids of the others.

Each stage works on all rows that the stage before kept and, but for the last,
returns the columns it was given, extra ones too; ``n_chars`` follows the text.
Null texts fail the quality rules. Empty tables pass through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinical_cohort.llm import decontamination, pieces, quality, secrets, simhash
from clinical_cohort.llm.common import saved, table


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it now is."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(decontamination.clean(docs, table(spark, sf_dir, "benchmark")))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(secrets.redact(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), pieces.N_BEST)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "scores", "alternatives")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("secret_scan", secret_scan),
    ("sentencepiece", encode),
]

#: SQL cannot express the lattice search; tests compare the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each stage's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
