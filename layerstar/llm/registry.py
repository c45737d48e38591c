"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerstar.llm import (decontaminate, fill_middle, html_text, language_id, license_scan, near_dup, oracle, packing,
                           quality, sharding, substring_dedup, token_links, url_filter, vector_dup)
from layerstar.llm.common import read_table

N_SHARDS = 24
LENGTH_BUCKETS, TOKEN_BUDGET = 16, 65536


#: Fixed by the query's contract.
URL_RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
             ("net/es/", "block"), ("net/fr/", "block"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the quality label of its number: 0 is bad."""
    outcomes = read_table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), (F.lit(1) - F.col("quality")).alias("bad"))
    judged = url_filter.judge_urls(read_table(spark, sf_dir, "pages"), outcomes, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sharding.shard_by_bytes(read_table(spark, sf_dir, "documents"), N_SHARDS)
    return s.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), LENGTH_BUCKETS, TOKEN_BUDGET)


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op6_vector_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dup.link_vectors(read_table(spark, sf_dir, "embeddings"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return d.select("doc_id", "text", "n_sentences", "n_removed")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return d.select("doc_id", "n_words", "n_hit", "n_items",
                    F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                    decontaminate.contaminated().alias("contaminated"))


def held_out() -> Column:
    """The third of the documents that no label may be learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", held_out())
    model = language_id.fit(docs.filter(~F.col("held_out")))
    return language_id.predict(docs, model, keep=("doc_id", "held_out"))


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.Model | None:
    """Learn ``quality`` from the labels of the documents that are not held out."""
    return quality.fit(docs, labels.filter(~held_out()).select("doc_id", "quality"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", held_out())
    model = quality_model(docs, read_table(spark, sf_dir, "labels"))
    scored = quality.with_score(docs.select("doc_id", "held_out", "text"), model)
    return scored.drop("text").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scan(docs).drop("spans")


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(read_table(spark, sf_dir, "documents"))


def op13_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_links.align(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_url_filter, op2_sharding, op3_packing, op4_html_text, op5_near_dup,
                                   op6_vector_dup, op7_substring_dedup, op8_decontamination,
                                   op9_language_id, op10_quality, op11_license_scan, op12_fill_middle,
                                   op13_token_links)}


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": oracle.OP1, "op2_sharding": oracle.OP2, "op3_packing": oracle.OP3,
            "op4_html_text": oracle.OP4, "op5_near_dup": oracle.OP5, "op6_vector_dup": oracle.OP6, "op8_decontamination": oracle.OP8,
            "op12_fill_middle": oracle.OP12}
