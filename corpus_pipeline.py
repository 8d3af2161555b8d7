"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a frame that is written as
Parquet and read again as the next one's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillsight.llm import curve_packing, decontamination, ngram_jaccard, quality_rules, secrets
from tillsight.llm.common import table
from tillsight.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a certified cutoff go."""
    return quality_rules.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: links are five-word shingles of similarity 0.8 or more."""
    return ngram_jaccard.representatives(docs, size=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; no document goes."""
    return secrets.masked(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences along the curve: one row per piece of a document, with its ids."""
    return curve_packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), special=True)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("secret scans", mask_secrets),
    ("packing", pack),
]

#: Tokens and the order along the curve are not SQL; tests/llm/test_pipeline.py holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    out = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, out if i == 0 else materialise(out, "stage"), sf_dir)
    return out
