"""Balanced contiguous shards from a global prefix sum of byte sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerstar.llm.common import prefix_sums

#: Bytes that a row costs besides its text.
ROW_OVERHEAD = 8


def shard_by_bytes(docs: DataFrame, n_shards: int, id_col: str = "doc_id",
                   text_col: str = "text", overhead: int = ROW_OVERHEAD) -> DataFrame:
    """Cut ``docs``, ordered by id, into ``n_shards`` contiguous shards of near-equal bytes.

    Returns one row per input row: ``id_col``, ``size`` (UTF-8 bytes of the text
    plus ``overhead``), ``text_crc32`` (NULL for a NULL text), ``shard``
    (0 .. n_shards-1) and ``slot`` (0, 1, 2, ... inside the shard, in id order).

    Only ids, sizes and checksums are shuffled, never a text.  Each stored range
    partition's byte total gives its offset in the global prefix sum; a row goes
    to the shard in which the middle of its byte interval falls, so a shard's
    size misses the target by less than one row.

    NULL texts have size ``overhead``; NULL ids come first; rows that share an
    id are ordered by checksum, size and scan position; an empty table gives an
    empty result; other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).alias("_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + F.lit(overhead)).cast("long").alias("_size"),
        F.crc32(F.col(text_col).cast("binary")).alias("_crc"))
    ranked = prefix_sums(rows, ["_id", "_crc", "_size"], weight="_size", name="shard-sizes")
    # the middle of the row's interval, in units of total / n_shards
    middle = (F.lit(2) * F.col("_before") + F.col("_size")).cast("decimal(38,0)") * F.lit(n_shards)
    cut = ranked.withColumn("shard", F.least(
        F.floor(middle / (F.lit(2) * F.col("_total"))).cast("int"), F.lit(n_shards - 1)))
    first = cut.groupBy("shard").agg(F.min("_rank").alias("_first"))   # n_shards rows
    return (cut.join(first, "shard")
            .select(F.col("_id").alias(id_col), F.col("_size").alias("size"),
                    F.col("_crc").alias("text_crc32"), "shard",
                    (F.col("_rank") - F.col("_first")).alias("slot")))
