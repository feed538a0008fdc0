"""Registered queries of the operators, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import lines, merkle, mixing, quality, ranking, setjoin, sharding, simhash, substrings, templates, topk, toxicity, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return run

    return add


@register("op3_simhash")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register("op4_jump_shards")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 15 of all documents under the law ``key``, and the shard among 17."""
    return sharding.assign_shards(table(spark, sf_dir, "documents"), 16)


@register("op1_line_dedup", lines.LINE_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines left of every document when later repeated runs of three lines go."""
    return lines.line_digest(table(spark, sf_dir, "documents"))


@register("op6_mix_sources", mixing.mix_sql())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and epochs taken for the target weights."""
    mixed = mixing.mix_documents(table(spark, sf_dir, "documents"))
    return mixed.selectExpr("doc_id", "domain", "coalesce(lang, '') lang", "coalesce(source, '') source", "tokens", "epoch")


@register("op7_url_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url by listed, then by mined rules."""
    return urls.judge_urls(table(spark, sf_dir, "pages"))


@register("op9_substring_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document when repeated windows of 20 words go."""
    return substrings.substring_digest(table(spark, sf_dir, "documents"))


@register("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op10_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op2_decontaminate")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contaminated documents with the benchmark items found in them."""
    return templates.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op5_pivot_top_k", topk.TOP_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other vectors of every vector whose id is divisible by 20."""
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@register("op11_chosen_path")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's set of two-word shingles and its group of similar documents."""
    return setjoin.similar_groups(table(spark, sf_dir, "documents"), shingle=2, percent=80)


@register("op12_merkle", merkle.merkle_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest digest of every document, and its proof after a third of the texts were tampered with."""
    return merkle.tamper_report(table(spark, sf_dir, "documents"))


@register("op13_ranked_search", ranking.RANKED_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return ranking.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
