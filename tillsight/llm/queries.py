"""The registered queries of the operators and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tillsight.llm import (
    balanced_shards, curve_packing, decontamination, language_id, ngram_jaccard, personal_data, quality_rules, recompression, repeats, secrets, sql,
    target_resampling, token_files, vector_codes,
)
from tillsight.llm.common import table
from tillsight.session import new_folder

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


@query("op10_quality_rules", sql.QUALITY_RULES)
def op10(spark, d):
    judged = quality_rules.judge(table(spark, d, "documents"), table(spark, d, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("failed_rules", ",").alias("failed_rules"))


@query("op1_decontamination", sql.DECONTAMINATION)
def op1(spark, d):
    found = decontamination.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def _joined(spans: str, keep: str = "true"):
    """kind:start:end of the spans, comma-joined in their order."""
    return F.array_join(F.expr(f"transform(filter({spans}, s -> {keep}), s -> concat(s.kind, ':', s.start, ':', s.end))"), ",")


@query("op5_personal_data")
def op5(spark, d):
    found = personal_data.personal_data(table(spark, d, "documents"))
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS LONG)").alias(f"n_{k}") for k in personal_data.BASE]
    return found.select("doc_id", *counts, F.sha2(_joined("spans", "s.base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


@query("op4_ngram_jaccard", sql.NGRAM_JACCARD)
def op4(spark, d):
    return ngram_jaccard.linked(table(spark, d, "documents"), size=3, percent=90).select("doc_id", "n_shingles", "component_id")


@query("op2_token_files")
def op2(spark, d):
    folder = new_folder(spark, "tokens")
    token_files.write_tokens(table(spark, d, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), special=True)
    return token_files.checksums(token_files.read_tokens(spark, folder))


@query("op9_curve_packing")
def op9(spark, d):
    return curve_packing.packed(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False, special=True).drop("ids")


@query("op3_secret_scans")
def op3(spark, d):
    found = secrets.scan(table(spark, d, "documents"))
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS LONG)").alias(f"n_{k}") for k in secrets.BASE]
    return found.select("doc_id", *counts, F.sha2(_joined("spans", "s.base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


@query("op8_language_id")
def op8(spark, d):
    return language_id.identify(table(spark, d, "documents"))


@query("op7_balanced_shards")
def op7(spark, d):
    return balanced_shards.sharded(table(spark, d, "documents"), shards=40)


@query("op6_repeats")
def op6(spark, d):
    return repeats.without_repeats(table(spark, d, "documents"), keep=False).drop("kept")


@query("op11_recompression", sql.RECOMPRESSION)
def op11(spark, d):
    return recompression.without_repeats(table(spark, d, "documents"), keep=False).drop("kept")


@query("op12_target_resampling", sql.TARGET_RESAMPLING)
def op12(spark, d):
    return target_resampling.drawn(table(spark, d, "documents"), table(spark, d, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


@query("op13_vector_codes", sql.VECTOR_CODES)
def op13(spark, d):
    return vector_codes.coded(table(spark, d, "embeddings"))
