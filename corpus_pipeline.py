"""The corpus pipeline: stages over ``documents``, each by one operator of layerstar.llm.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame.  ``run`` writes each stage's result as Parquet to the
shared folder and hands the reread table to the next stage; what a stage stored on
its way, and the table before it, then go.  All stages but the last return the
columns they were given.

Defined results, beside those that the operators state: a NULL ``doc_id`` is an
id like any other but sorts last; an empty table passes through; columns beyond
those of ``documents`` are carried along, and those with names that an operator
uses keep their values.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerstar.llm import decontaminate, near_dup, packing, quality, substring_dedup
from layerstar.llm.common import delete, read_table, shuffles_cleaned, stage, staging_area
from layerstar.llm.registry import LENGTH_BUCKETS, TOKEN_BUDGET, quality_model
from layerstar.session import work_root

#: Two hashes of id and text that tell rows apart while a stage works.
KEYS = ["__row_key_1", "__row_key_2"]
ROW = "__row"
#: A document is rejected below this likelihood of quality label 1.
LEAST_QUALITY = 0.5


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go.

    It learns from the labels of the documents that are not held out; where it
    can learn nothing, nothing is rejected.
    """
    model = quality_model(docs, read_table(spark, sf_dir, "labels"))
    scored = quality.with_score(docs, model, score_col="__quality_score")
    return scored.filter(F.col("__quality_score") >= LEAST_QUALITY).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: of each group the document of the least id stays.

    Rows of one id are told apart by their texts; of rows equal in both, one
    stays.  Documents without words are no group and all stay, but for such
    repeated rows.
    """
    text_key, id_key = F.xxhash64("text", "doc_id"), F.xxhash64("doc_id", F.lit(1), "text")
    rows = docs.withColumns({KEYS[0]: text_key, KEYS[1]: id_key})
    name = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", *KEYS)
    kept = near_dup.near_duplicates(rows.select(name.alias("id"), "text"), "id").filter("kept")
    kept = kept.select(*[f"id.{k}" for k in KEYS])
    return rows.join(kept, KEYS, "left_semi").dropDuplicates(KEYS).select(*docs.columns)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: repeated spans of sentences leave the texts; every row stays.

    ``n_chars`` follows the text where it has changed.
    """
    cut = substring_dedup.remove_repeats(docs, count_cols=("__sentences", "__removed"))
    chars = F.when(F.col("__removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a twentieth of their words in benchmark windows go."""
    found = decontaminate.contamination(docs, read_table(spark, sf_dir, "benchmark"))
    dirty = found.filter(decontaminate.contaminated()).select("doc_id", "check").distinct()
    same = F.col("d.doc_id").eqNullSafe(F.col("x.doc_id")) & (F.xxhash64("d.text") == F.col("x.check"))
    return docs.alias("d").join(dirty.alias("x"), same, "left_anti")


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: every kept document, with all its columns, gets its bucket, batch and slot.

    The rows are stored with a number of their own, by which the slots are tied
    to them: ids may be NULL or repeat.  Columns with the names of the packing are
    replaced.
    """
    rows = stage(docs.withColumn(ROW, F.monotonically_increasing_id()), "to-pack")
    packed = packing.pack(rows.select(F.struct("doc_id", ROW).alias("id"), "text"), LENGTH_BUCKETS, TOKEN_BUDGET, id_col="id")
    made = [c for c in packed.columns if c != "id"]
    slots = packed.select(F.col(f"id.{ROW}").alias(ROW), *made)
    return rows.drop(*made).join(slots, ROW).drop(ROW)


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("substring dedup", drop_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack_documents),
]

#: Training the classifier is not SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's table, after all stages over the whole ``documents`` table:
    the kept documents with their cleaned texts, their other columns and their places."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    folder = f"{work_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, step) in enumerate(STAGES):
        path = f"{folder}/{number}"
        with staging_area(spark), shuffles_cleaned(spark):
            step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs
