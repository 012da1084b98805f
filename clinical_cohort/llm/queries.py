"""The queries opN_<name>: each operator over its whole table, with the contract's columns."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinical_cohort.session import scratch_path

from . import (decontamination, licenses, oracles, pieces, quality, repeats, runs, secrets, simhash, spelling, token_counts,
               token_output, toxicity, warc)
from .common import saved, table
from .registry import register


@register("op6_quality_rules", oracles.QUALITY)
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words",
        base_failed.alias("base_failed"), (~base_failed & F.col("kept")).alias("kept"))


def _span_text(found):
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@register("op2_secret_scan", oracles.SECRETS)
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secrets.BASE]
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(_span_text(F.filter("found", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        _span_text(F.col("found")).alias("spans"))


@register("op5_decontaminate", oracles.DECONTAMINATION)
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = decontamination.match(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hit.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hit_items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@register("op4_simhash_dedup")
def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = simhash.group(table(spark, sf_dir, "documents"))
    return grouped.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op3_token_output")
def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_path(spark, 'tokens')}-{uuid.uuid4().hex}"
    token_output.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_output.read(spark, path)


@register("op10_sentencepiece")
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@register("op8_substring_dedup")
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(table(spark, sf_dir, "documents"))


@register("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op7_warc_fixity", oracles.WARC)
def op7_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of a replica in which some records, chosen by digest, are changed, cut short or lost."""
    ours = saved(warc.archive(table(spark, sf_dir, "pages")), "archive")
    fate = F.pmod(F.conv(F.substring(F.sha2("bytes", 256), 9, 8), 16, 10).cast("long"), F.lit(500))
    half = (F.octet_length("bytes") / 2).cast("int")
    harmed = (F.when(fate == 0, F.overlay("bytes", F.lit(b"\0"), half))
              .when(fate == 1, F.substring("bytes", F.lit(1), half)).otherwise(F.col("bytes")))
    theirs = saved(ours.where(fate != 2).withColumn("bytes", harmed), "replica")
    return warc.fixity(ours, theirs)


@register("op9_license_scan", oracles.LICENSES)
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.recognise(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_known", F.array_join("licenses", ",").alias("licenses"))


@register("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents"))


@register("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(table(spark, sf_dir, "documents"))


@register("op13_token_counts")
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
