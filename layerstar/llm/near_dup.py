"""MinHash near-duplicates with odd sketches and exact confirmation."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerstar.llm import words as W
from layerstar.llm.common import map_arrow, reshuffled, stage
from layerstar.llm.components import connected_components

#: Words of a shingle, and the least similarity of linked texts in hundredths.
SHINGLE, PERCENT = 5, 75
#: 32 bands of 4 samples miss a pair at 0.75 with probability 5e-6.
BANDS, ROWS = 32, 4
#: Bits of the odd sketch, in longs of 64.
SKETCH_LONGS = 8
#: Longs of the parity bitmap of the whole set, for the texts that have candidates.
PARITY_LONGS = 32
#: A pair whose estimate is this far below the threshold is not read in full:
#: 4.6 standard deviations of the estimate.
SLACK = 0.21
#: Rows of one tile side when the members of a bucket are compared.
TILE = 256
#: Rounds of comparing bucket members with one hub each before the rest is compared in tiles.
HUB_ROUNDS = 3

_rng = np.random.default_rng(20240501)
_MULT = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_SALT = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)

SIGNATURE = "n long, node long, bands array<long>, sketch array<long>"


def _sets(texts: pa.Array) -> Iterator[list[np.ndarray]]:
    """Distinct shingle hashes of each text, group by group."""
    for group in W.word_groups(texts, W.SPACED):
        value, first = W.shingles(group, SHINGLE)
        yield [np.unique(value[first[i]:first[i + 1]]) for i in range(len(group))]


def _fingerprints(flat: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of each set; two different sets share one with a chance of 5e-20."""
    return np.bitwise_xor.reduceat(W.mix(flat ^ _SALT[0]), first).view(np.int64)


def _signatures(sets: list[np.ndarray]) -> list[np.ndarray]:
    """n, node, bands and sketch of the non-empty sets."""
    n = np.array([len(s) for s in sets], dtype=np.int64)
    flat, first = np.concatenate(sets), np.concatenate([[0], np.cumsum(n)[:-1]])
    node = _fingerprints(flat, first)
    samples = np.empty((len(sets), BANDS * ROWS), dtype=np.uint64)
    for i in range(BANDS * ROWS):
        samples[:, i] = np.minimum.reduceat(flat * _MULT[i] + _ADD[i], first)
    bands = np.empty((len(sets), BANDS), dtype=np.uint64)
    for b in range(BANDS):
        h = np.full(len(sets), b, dtype=np.uint64)
        for i in range(b * ROWS, (b + 1) * ROWS):
            h = W.mix(h ^ samples[:, i])
        bands[:, b] = h
    # the odd sketch: each sample flips one bit, so equal samples of two texts cancel in their XOR
    sketch = np.zeros((len(sets), SKETCH_LONGS), dtype=np.uint64)
    every = np.arange(len(sets))
    for i in range(BANDS * ROWS):
        bit = W.mix(samples[:, i] ^ _SALT[i]) % np.uint64(64 * SKETCH_LONGS)
        sketch[every, (bit >> np.uint64(6)).astype(np.int64)] ^= np.uint64(1) << (bit & np.uint64(63))
    return [n, node, bands.view(np.int64), sketch.view(np.int64)]


def _lists(values: np.ndarray, has: np.ndarray) -> pa.Array:
    """A list per row, empty where ``has`` is false."""
    at = np.concatenate([[0], np.cumsum(np.where(has, values.shape[1], 0))])
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values.ravel(), pa.int64()))


def _sign_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, k, text) -> (id, k, signature); a text without words has n = 0 and no signature."""
    for batch in batches:
        row = 0
        for sets in _sets(batch.column(2)):
            n = np.array([len(s) for s in sets], dtype=np.int64)
            has = n > 0
            scalars = np.zeros((2, len(sets)), dtype=np.int64)
            bands, sketch = np.zeros((0, BANDS), np.int64), np.zeros((0, SKETCH_LONGS), np.int64)
            if has.any():
                *two, bands, sketch = _signatures([s for s in sets if len(s)])
                scalars[:, has] = two
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, len(sets)), batch.column(1).slice(row, len(sets)),
                 *[pa.array(x) for x in scalars], _lists(bands, has), _lists(sketch, has)],
                names=["id", "k", "n", "node", "bands", "sketch"])
            row += len(sets)


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, text) -> (node, text, parity), for texts that the node's signature was made of.

    Texts are fetched by a hash of their id, which another row may share.
    """
    bits = np.uint64(64 * PARITY_LONGS)
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            sets = [s for group in _sets(batch.column(1)) for s in group]
            node = batch.column(0).to_numpy()
            fits, parity = [], []
            for i, s in enumerate(sets):
                if len(s) and _fingerprints(s, np.array([0]))[0] == node[i]:
                    odd = np.bincount((W.mix(s ^ _SALT[2]) % bits).astype(np.int64), minlength=int(bits)) & 1
                    parity.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
                    fits.append(i)
            if fits:
                parity = np.stack(parity)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(pa.array(fits)) for c in (0, 1)), _lists(parity, np.ones(len(fits), bool))],
                    names=["node", "text", "parity"])


def _confirm_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, text_a, text_b) -> the pairs (a, b) whose full sets are similar enough."""
    for whole in batches:
        for at in range(0, whole.num_rows, 128):
            batch = whole.slice(at, 128)
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            left, right = ([s for group in _sets(batch.column(c)) for s in group] for c in (2, 3))
            linked = np.zeros(batch.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(left, right, strict=True)):
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked[i] = 100 * common >= PERCENT * (len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays([pa.array(a[linked]), pa.array(b[linked])], names=["a", "b"])


def _odd_bits(x: Column, y: Column, longs: int) -> Column:
    """Population count of the XOR of two bitmaps."""
    return sum((F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(longs)), F.lit(0))


def may_link(a: str, b: str) -> Column:
    """True where set sizes, odd sketches and parity bitmaps leave a link possible.

    With k samples and s bits, a similarity J puts s/2 * (1 - exp(-4k(1-J)/s))
    bits into the XOR of two odd sketches.  The XOR of two whole sets' parity
    bitmaps has at most one bit per element that only one of them holds, and a
    link allows (1-J)/(1+J) of the summed sizes of those: this bound is strict.
    """
    n, sketch, parity = ([F.col(f"{side}.{c}") for side in (a, b)] for c in ("n", "sketch", "parity"))
    bits = 64 * SKETCH_LONGS
    least = PERCENT / 100 - SLACK
    most = math.ceil(bits / 2 * (1 - math.exp(-4 * BANDS * ROWS * (1 - least) / bits)))
    return ((F.least(*n) * 100 >= F.greatest(*n) * PERCENT)
            & (_odd_bits(*sketch, SKETCH_LONGS) <= most)
            & (_odd_bits(*parity, PARITY_LONGS) * (100 + PERCENT) <= (n[0] + n[1]) * (100 - PERCENT)))


def _with_sketches(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs whose bitmaps leave a link possible."""
    p, x, y = pairs.alias("p"), nodes.alias("x"), nodes.alias("y")
    return (p.join(x, F.col("p.a") == F.col("x.node")).join(y, F.col("p.b") == F.col("y.node"))
            .filter(may_link("x", "y")).select("p.a", "p.b"))


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs confirmed on their full shingle sets."""
    side = [texts.select(F.col("node").alias(c), F.col("text").alias(f"t_{c}")) for c in ("a", "b")]
    both = pairs.join(side[0], "a").join(side[1], "b").select("a", "b", "t_a", "t_b")
    return map_arrow(both, _confirm_batches, "a long, b long").distinct()


def _merge(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Component labels after the linked components have been joined."""
    label = [comps.select(F.col("node").alias(c), F.col("comp").alias(x)) for c, x in (("a", "u"), ("b", "v"))]
    edges = links.join(label[0], "a").join(label[1], "b").select("u", "v")
    joined = connected_components(edges).select(F.col("node").alias("comp"), F.col("comp").alias("_new"))
    return stage(comps.join(joined, "comp", "left")
                 .select("node", F.coalesce("_new", "comp").alias("comp")), "near-dup-comps")


def _ordered(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _hub_pairs(members: DataFrame, turn: int) -> DataFrame:
    """Each member with the hub of its bucket, if that is in another component.

    The hub is the member of the least hash; another turn has other hubs.
    """
    rank = F.xxhash64("node", F.lit(turn))
    hubs = (members.groupBy("key").agg(F.min_by("node", rank).alias("hub"), F.min_by("comp", rank).alias("hub_comp"),
                                       F.min("comp").alias("lo"), F.max("comp").alias("hi"))
            .filter("lo <> hi").drop("lo", "hi"))
    return (members.join(reshuffled(hubs, "key"), "key").filter("comp <> hub_comp")
            .select(*_ordered(F.col("node"), F.col("hub"))).distinct())


def _tile_pairs(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """All pairs of a bucket from different components whose bitmaps leave a link possible.

    A bucket's members are dealt into blocks of about TILE; every pair of blocks
    is a join key of its own, and the test of the bitmaps is part of the join.
    """
    mixed = (members.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
             .filter("lo <> hi").select("key", F.ceil(F.col("m") / TILE).cast("int").alias("blocks")))
    rows = (members.join(reshuffled(mixed, "key"), "key").join(nodes, "node")
            .withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int")))
    left = rows.withColumn("j", F.explode(F.sequence("own", F.col("blocks") - 1))).withColumnRenamed("own", "i")
    right = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("own")))).withColumnRenamed("own", "j")
    x, y = left.alias("x"), right.alias("y")
    c = lambda side, name: F.col(f"{side}.{name}")
    match = ((c("x", "key") == c("y", "key")) & (c("x", "i") == c("y", "i")) & (c("x", "j") == c("y", "j"))
             & (c("x", "comp") != c("y", "comp"))
             & ((c("x", "i") != c("x", "j")) | (c("x", "node") < c("y", "node")))
             & may_link("x", "y"))
    return x.join(y, match).select(*_ordered(c("x", "node"), c("y", "node"))).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Group texts whose 5-word shingle sets have a similarity of 0.75 or more.

    Returns one row per input row: ``id_col``, ``n_shingles`` (size of the set),
    ``component_id`` (least id reachable over links) and ``kept`` (the row's id
    is the component's).  Words are split at ASCII white space, A-Z lower-cased.

    1. Each text's set is folded into BANDS * ROWS MinHash samples, band keys
       and an odd sketch; texts of equal sets (by fingerprint) become one node.
    2. Nodes that share a band key are candidates.  A member is compared with
       its bucket's hub, not with every other member; linked members merge into
       components, and only buckets that still hold several components go on:
       to other hubs, and at the end to all pairs between components, in tiles.
       So no bucket, however large, has all its pairs written out, and no pair
       of a bucket that could still join two components is left out.
    3. The odd sketches' XOR population count must leave a link possible, and so
       must the parity bitmaps of the whole sets; then the full sets decide.

    Texts without words (NULL, empty, blank) are linked with nothing.  A NULL id
    takes part by its text and never names a component; a component of NULL ids
    alone has a NULL ``component_id`` and is kept.  Rows that share an id are
    judged by their own texts.  An empty table gives an empty result; other
    columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"),
                       F.coalesce(F.when(F.col(id_col).isNotNull(), F.xxhash64(id_col)),
                                  F.xxhash64(text_col)).alias("k"),
                       F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    signed = stage(map_arrow(rows, _sign_batches, f"id {id_type}, k long, {SIGNATURE}"), "near-dup-signatures")

    nodes = stage(signed.filter("n > 0").groupBy("node")
                  .agg(F.min("k").alias("k"), F.first("n").alias("n"), F.first("bands").alias("bands"),
                       F.first("sketch").alias("sketch")), "near-dup-nodes")
    in_band = nodes.select("node", F.explode("bands").alias("key"))
    shared = in_band.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("key")
    buckets = stage(in_band.join(reshuffled(shared, "key"), "key"), "near-dup-buckets")
    suspects = buckets.select("node").distinct().join(nodes.select("node", "k", "n", "sketch"), "node")
    suspects = stage(suspects, "near-dup-suspects")
    texts = rows.select("k", "text").join(suspects.select("node", "k"), "k").select("node", "text")
    texts = stage(map_arrow(texts, _text_batches, "node long, text string, parity array<long>"), "near-dup-texts")
    suspects = stage(suspects.drop("k").join(texts.select("node", "parity").dropDuplicates(["node"]), "node"),
                     "near-dup-suspects")

    comps = stage(suspects.select("node", F.col("node").alias("comp")), "near-dup-comps")
    tested, turn = None, 0
    while True:
        members = buckets.join(comps, "node")
        last = turn >= HUB_ROUNDS
        pairs = _tile_pairs(members, suspects) if last else _with_sketches(_hub_pairs(members, turn), suspects)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stage(pairs, "near-dup-pairs")
        links = stage(_confirmed(pairs, texts), "near-dup-links")
        linked = not links.isEmpty()
        if linked:
            comps = _merge(comps, links)
        if last:
            break
        turn = turn + 1 if linked else HUB_ROUNDS      # where hubs find nothing more, the tiles follow
        tested = pairs if tested is None else stage(tested.unionByName(pairs), "near-dup-tested")

    labelled = (signed.select("id", "n", F.when(F.col("n") > 0, F.col("node")).alias("node"))
                .join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    least = labelled.filter("comp is not null").groupBy("comp").agg(F.min("id").alias("least"))
    out = labelled.join(reshuffled(least, "comp"), "comp", "left")
    component = F.when(F.col("comp").isNull(), F.col("id")).otherwise(F.col("least"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))
