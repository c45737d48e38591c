"""Optimal length buckets and token-budget batches."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerstar.llm.common import prefix_sums, stage, text_or_empty

#: Lengths up to EXACT have a histogram cell each; beyond it every octave has
#: PER_OCTAVE cells, so the histogram has at most EXACT + 1 + 53 * PER_OCTAVE
#: rows however long the texts and however many of them there are.
EXACT = 1024
PER_OCTAVE = 256


def word_count(text: str | Column) -> Column:
    """Words between ASCII white space; NULL and empty texts have none."""
    return F.regexp_count(text_or_empty(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def length_cell(length: Column) -> Column:
    """Largest length of the histogram cell that ``length`` falls in."""
    octave = F.floor(F.log2(length.cast("double")))
    width = F.pow(F.lit(2.0), octave) / F.lit(float(PER_OCTAVE))
    return F.when(length <= EXACT, length).otherwise((F.ceil(length / width) * width).cast("long"))


def length_histogram(rows: DataFrame, length: str) -> DataFrame:
    """(cell, n, longest) over all rows, summed before the shuffle."""
    return (rows.groupBy(length_cell(F.col(length)).alias("cell"))
            .agg(F.count(F.lit(1)).alias("n"), F.max(length).alias("longest")))


def optimal_boundaries(longest: Sequence[int], counts: Sequence[int], n_buckets: int) -> list[int]:
    """Bucket boundaries with the least padding for a histogram in rising order.

    A bucket pads each of its rows to its longest one.  ``cost[k][j]``, the
    least padded total of the first j cells in k buckets, is the minimum over i
    of ``cost[k-1][i] + longest[j-1] * (rows in cells i..j-1)``.
    """
    top = np.asarray(longest, dtype=np.float64)
    cum = np.concatenate([[0.0], np.cumsum(np.asarray(counts, dtype=np.float64))])
    m = len(top)
    if m == 0:
        return []
    k_max = min(n_buckets, m)
    cost = np.full(m + 1, np.inf)
    cost[0] = 0.0
    cuts = []
    for _ in range(k_max):
        new = np.full(m + 1, np.inf)
        new[0] = 0.0
        cut = np.zeros(m + 1, dtype=np.int64)
        for j in range(1, m + 1):
            c = cost[:j] + top[j - 1] * (cum[j] - cum[:j])
            cut[j] = i = int(np.argmin(c))
            new[j] = c[i]
        cost, cuts = new, [*cuts, cut]
    out, j = [], m
    for cut in reversed(cuts):
        if j == 0:
            break
        out.append(int(top[j - 1]))
        j = int(cut[j])
    return sorted(set(out))


def pack(docs: DataFrame, n_buckets: int = 16, token_budget: int = 65536, id_col: str = "doc_id",
         text_col: str = "text", length: Column | None = None) -> DataFrame:
    """Pack rows into batches of at most ``token_budget`` padded tokens.

    Returns one row per input row: ``id_col``, ``n_tokens`` (``length``; words
    by default), ``bucket``, ``bucket_len`` (the length that its rows are padded
    to), ``batch`` (0, 1, 2, ... over all buckets) and ``slot`` (position in the
    batch).  Boundaries come from dynamic programming over the histogram of all
    lengths, whose size is bounded (see ``EXACT``); it is the only thing that
    the driver sees.  A batch holds ``token_budget // bucket_len`` rows, one at
    least, so a text beyond the budget is a batch of its own.

    NULL and empty texts have 0 tokens and are packed as well; NULL and repeated
    ids are rows like any other, ordered by id and then by scan position; an
    empty table gives an empty result; other columns are ignored.
    """
    n_tokens = F.coalesce(length if length is not None else word_count(text_col), F.lit(0))
    # the texts are read once; histogram, ranges and ranks come from the stored lengths
    rows = stage(docs.select(F.col(id_col).alias("_id"), n_tokens.cast("long").alias("_len")), "pack-lengths")
    cells = length_histogram(rows, "_len").orderBy("longest").collect()
    bounds = optimal_boundaries([c["longest"] for c in cells], [c["n"] for c in cells], n_buckets)

    capacity = [max(1, token_budget // max(1, b)) for b in bounds]
    n_rows = [0] * len(bounds)
    for c in cells:
        n_rows[int(np.searchsorted(bounds, c["longest"]))] += c["n"]
    first_batch = [0]
    for n, cap in zip(n_rows, capacity, strict=True):
        first_batch.append(first_batch[-1] + -(-n // cap))

    bucket = F.lit(max(0, len(bounds) - 1))
    for k in range(len(bounds) - 2, -1, -1):
        bucket = F.when(F.col("_len") <= bounds[k], F.lit(k)).otherwise(bucket)
    per_bucket = [F.array(*[F.lit(v).cast("long") for v in values or [0]])
                  for values in (bounds, capacity, first_batch)]
    bucket_len, cap, start = (a[F.col("_bucket")] for a in per_bucket)
    # a bucket may hold most of the rows, so its rows are numbered across partitions
    ranked = prefix_sums(rows.withColumn("_bucket", bucket.cast("int")), ["_id", "_len"],
                         group="_bucket", name="pack-ranks")
    return ranked.select(
        F.col("_id").alias(id_col), F.col("_len").alias("n_tokens"), F.col("_bucket").alias("bucket"),
        bucket_len.alias("bucket_len"),
        (start + F.floor(F.col("_rank") / cap)).cast("long").alias("batch"),
        (F.col("_rank") % cap).cast("int").alias("slot"))
