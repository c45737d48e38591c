"""Benchmark decontamination by a prefix-filtered join of word windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerstar.llm import words as W
from layerstar.llm.common import map_arrow, stage

#: Words of a window; an item of fewer words, but not none, is one window.
WINDOW = 13
#: Words of the shingles whose rarity orders a window (shorter windows: all their words).
SHINGLE = 4
#: Bits of the bitmap that tells which corpus shingles can matter: 1 MB whatever the benchmark's
#: size.  A fuller bitmap lets more rows into the join, never fewer.
BITMAP_BITS = 1 << 23


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    at = np.concatenate([[0], np.cumsum(counts)])
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, pa.int64()))


def _window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, text) -> (item, window hash, its word hashes), a row per window."""
    for batch in batches:
        for g in W.word_groups(batch.column(1), W.ALNUM):
            items, windows, lists = [], [], []
            for i in range(len(g)):
                h = g.hash[g.first[i]:g.first[i + 1]]
                size = min(WINDOW, len(h))
                if size:
                    runs = W.run_hashes(h, size)
                    items += [g.row + i] * len(runs)
                    windows.append(runs)
                    lists += [h[j:j + size] for j in range(len(runs))]
            if items:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(items)), pa.array(np.concatenate(windows).view(np.int64)),
                     _lists(np.concatenate(lists).view(np.int64), np.array([len(x) for x in lists]))],
                    names=["item", "window", "words"])


def _shingle_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(window, words) -> (window, size, offset, shingle), a row per shingle of a window."""
    for batch in batches:
        window, words = batch.column(0).to_numpy(), batch.column(1)
        rows = []
        for w, h in zip(window.tolist(), words.to_pylist(), strict=True):
            h = np.array(h, dtype=np.int64).view(np.uint64)
            size = min(SHINGLE, len(h))
            rows += [(w, size, at, s) for at, s in enumerate(W.run_hashes(h, size).view(np.int64).tolist())]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.int64()), strict=True)],
                names=["window", "size", "offset", "shingle"])


def _bitmap(shingles: DataFrame) -> np.ndarray:
    """A bitmap of the ``shingle`` column, BITMAP_BITS wide at any number of rows."""
    bit = F.col("shingle").bitwiseAND(F.lit(BITMAP_BITS - 1))
    longs = (shingles.select(F.shiftright(bit, 6).cast("int").alias("at"),
                             F.expr("shiftleft(1L, cast(shingle & 63 AS int))").alias("bit"))
             .groupBy("at").agg(F.bit_or("bit").alias("bits")))
    out = np.zeros(BITMAP_BITS // 64, dtype=np.int64)
    for r in longs.collect():           # at most BITMAP_BITS / 64 rows
        out[r["at"]] = r["bits"]
    return out.view(np.uint64)


def _count_batches(bitmap: np.ndarray, sizes: list[int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(text) -> (shingle, times), summed over each group of texts."""
        for batch in batches:
            for g in W.word_groups(batch.column(0), W.ALNUM):
                found = np.concatenate([_listed(g, size, bitmap)[1] for size in sizes])
                value, times = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(times)],
                                                 names=["shingle", "times"])
    return run


def _listed(g: W.Words, size: int, bitmap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the group's shingles of ``size`` words that the bitmap has."""
    value = W.run_hashes(g.hash, size)
    bit = value & np.uint64(64 * len(bitmap) - 1)
    at = np.flatnonzero((bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1))
    # a shingle lies inside one text
    text = np.searchsorted(g.first, at, side="right") - 1
    at = at[at + size <= g.first[text + 1]]
    return at, value[at]


def _probe_batches(bitmap: np.ndarray, sizes: list[int]) -> Callable:
    reach = WINDOW - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, check, text) -> (id, check, n_words, probes): the positions that can hold a prefix shingle,
        each with the words around it."""
        for batch in batches:
            for g in W.word_groups(batch.column(2), W.ALNUM):
                parts = [_listed(g, size, bitmap) for size in sizes]
                at, value = (np.concatenate(x) for x in zip(*parts, strict=True))
                order = np.argsort(at, kind="stable")
                at, value = at[order], value[order]
                text = np.searchsorted(g.first, at, side="right") - 1
                begin = np.maximum(at - reach, g.first[text])
                stop = np.minimum(at + WINDOW, g.first[text + 1])
                length = stop - begin
                index = np.repeat(begin, length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
                probes = pa.StructArray.from_arrays(
                    [pa.array(value.view(np.int64)), pa.array((at - g.first[text]).astype(np.int32)),
                     pa.array((begin - g.first[text]).astype(np.int32)), _lists(g.hash[index].view(np.int64), length)],
                    names=["shingle", "at", "near", "words"])
                per_text = np.searchsorted(at, g.first).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(g.row, len(g)), batch.column(1).slice(g.row, len(g)),
                     pa.array(np.diff(g.first)), pa.ListArray.from_arrays(pa.array(per_text), probes)],
                    names=["id", "check", "n_words", "probes"])
    return run


def _same_row(a_id: str, a_check: str, b_id: str, b_check: str):
    return F.col(a_id).eqNullSafe(F.col(b_id)) & F.col(a_check).eqNullSafe(F.col(b_check))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Find the words of each document that lie in a window of a benchmark item.

    Returns one row per input row: ``id_col``, ``check`` (a hash of the text,
    which tells rows of one id apart), ``n_words``, ``n_hit`` (words inside any
    occurrence of a window), ``n_items`` (items with occurring windows) and
    ``items`` (their ids as sorted strings).  Words are runs of letters, digits
    and non-ASCII characters, A-Z lower-cased.

    1. Every item gives its windows of WINDOW words and every window its
       shingles; one pass over all documents counts those shingles.
    2. A window occurs only where all of its shingles do, so its rarest shingle
       alone is its prefix; a window with a shingle that no document has is out.
    3. A second pass gives the places of prefix shingles with the words around
       them.  They are joined with the prefixes; the shingle's offset fixes
       where the window would begin (positional bound), the document must have
       words enough from there (length bound), and the window's words must be
       the words found there.

    NULL and empty texts have no words and no hits, such items no windows.  An
    item with a NULL id counts its words but is not listed.  Rows that share an
    id are judged by their own texts, items that share an id are one.  An empty
    table of documents gives an empty result, an empty benchmark no hits; other
    columns are ignored.
    """
    item_type = items.schema[item_id_col].dataType.simpleString()
    owned = stage(map_arrow(items.select(item_id_col, item_text_col), _window_batches,
                            f"item {item_type}, window long, words array<long>"), "item-windows")
    windows = stage(owned.groupBy("window").agg(F.first("words").alias("words")), "windows")
    shingles = stage(map_arrow(windows, _shingle_batches, "window long, size int, offset int, shingle long"),
                     "window-shingles")
    sizes = [r["size"] for r in shingles.select("size").distinct().collect()] or [SHINGLE]   # SHINGLE at most

    counting = _count_batches(_bitmap(shingles), sizes)
    times = (map_arrow(docs.select(text_col), counting, "shingle long, times long")
             .groupBy("shingle").agg(F.sum("times").alias("times")))
    rarest = F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "shingle", "offset"))
    prefixes = stage(shingles.join(times, "shingle", "left").groupBy("window").agg(rarest.alias("p"))
                     .filter("p.times > 0").join(windows, "window")
                     .select("window", "p.shingle", "p.offset", "words", F.size("words").alias("length")), "prefixes")

    id_type = docs.schema[id_col].dataType.simpleString()
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("check"), F.col(text_col).alias("text"))
    probing = _probe_batches(_bitmap(prefixes), sizes)
    probed = stage(map_arrow(
        keyed, probing, f"id {id_type}, check long, n_words long, "
        "probes array<struct<shingle:long,at:int,near:int,words:array<long>>>"), "probes")
    places = probed.select("id", "check", "n_words", F.explode("probes").alias("q"))
    begin = F.col("q.at") - F.col("offset")
    hits = stage(places.join(prefixes, F.col("q.shingle") == prefixes["shingle"])
                 .filter((begin >= 0) & (begin + F.col("length") <= F.col("n_words"))
                         & (F.slice(F.col("q.words"), begin - F.col("q.near") + 1, F.col("length")) == F.col("words")))
                 .select("id", "check", begin.alias("begin"), "length", "window").distinct(), "hits")

    # words covered: each occurrence adds what lies beyond the furthest end before it
    longest = hits.groupBy("id", "check", "begin").agg(F.max("length").alias("length"))
    earlier = Window.partitionBy("id", "check").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("begin") + F.col("length")
    fresh = F.greatest(F.lit(0), end - F.greatest("begin", F.coalesce(F.max(end).over(earlier), F.lit(0))))
    covered = (longest.withColumn("fresh", fresh).groupBy("id", "check").agg(F.sum("fresh").alias("n_hit")))
    listed = (hits.select("id", "check", "window").distinct().join(owned.select("window", "item").distinct(), "window")
              .groupBy("id", "check").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items")))
    c, i = covered.alias("c"), listed.alias("i")
    found = (c.join(i, _same_row("c.id", "c.check", "i.id", "i.check"), "left")
             .select("c.id", "c.check", "c.n_hit", "i.items"))
    p, f = probed.select("id", "check", "n_words").alias("p"), found.alias("f")
    none = F.array().cast("array<string>")
    return (p.join(f, _same_row("p.id", "p.check", "f.id", "f.check"), "left")
            .select(F.col("p.id").alias(id_col), "p.check", "n_words",
                    F.coalesce("f.n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("f.items", none).alias("items"))
            .withColumn("n_items", F.size("items").cast("long")))


def contaminated() -> Column:
    """A twentieth of the words, at least, lie in benchmark windows."""
    return (F.col("n_hit") > 0) & (F.lit(20) * F.col("n_hit") >= F.col("n_words"))
