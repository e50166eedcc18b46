"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeward.llm import ann, bestfit, collocations, divergence, html, mixing, packing, quality, simhash, substrings, syncmers, toxicity, urlfilter
from lakeward.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.filter_pages(spark, table(spark, sf_dir, "pages"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.kept_digest(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.best_fit(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_main_text": op1_main_text,
    "op2_url_filter": op2_url_filter,
    "op3_toxicity": op3_toxicity,
    "op4_nearest": op4_nearest,
    "op5_source_mix": op5_source_mix,
    "op6_quality": op6_quality,
    "op7_syncmers": op7_syncmers,
    "op8_packing": op8_packing,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_simhash": op10_simhash,
    "op11_best_fit": op11_best_fit,
    "op12_collocations": op12_collocations,
    "op13_source_audit": op13_source_audit,
}
ORACLES: dict[str, str] = {
    "op2_url_filter": urlfilter.FILTER_SQL,
    "op5_source_mix": mixing.MIX_SQL,
    "op12_collocations": collocations.COLLOCATIONS_SQL,
    "op13_source_audit": divergence.AUDIT_SQL,
}
