"""Embedding near-duplicates by PCA-ordered tiled comparison."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerstar.llm.common import map_arrow, prefix_sums, reshuffled, stage
from layerstar.llm.components import connected_components

#: Least cosine of linked vectors.
THRESHOLD = 0.9
#: Vectors of a block; a tile compares two blocks.
BLOCK = 8192
#: Leading dimensions after which the bound is tested.
STEPS = (16, 32)
#: Rows of a tile that are compared at a time.
STRIP = 512
#: Surviving pairs that are compared in full at a time.
PAIRS = 1 << 16
#: What single precision may add or take in the leading dimensions.
TOLERANCE = 1e-4


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """The rows of a list array of ``dim`` numbers each."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    # scaled by the largest component first, so that no square overflows or vanishes
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _moment_batches(dim: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(vector) -> (cell, value): the partition's sum of outer products of unit vectors."""
        total = np.zeros((dim, dim))
        for batch in batches:
            if batch.num_rows:
                u = _unit(_matrix(batch.column(0), dim))
                total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim)), pa.array(total.ravel())],
                                         names=["cell", "value"])
    return run


def principal_axes(vectors: DataFrame, dim: int) -> np.ndarray:
    """Orthogonal axes (columns) by falling second moment of the unit vectors.

    The partitions' sums are added by Spark; dim * dim numbers reach the driver.
    """
    sums = (map_arrow(vectors.select("vector"), _moment_batches(dim), "cell long, value double")
            .groupBy("cell").agg(F.sum("value").alias("value")).collect())
    moment = np.zeros(dim * dim)
    for r in sums:
        moment[r["cell"]] = r["value"]
    _, axes = np.linalg.eigh(moment.reshape(dim, dim))
    return np.ascontiguousarray(axes[:, ::-1])


def _lead_batches(axes: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, vector) -> (id, vector, lead): the coordinate on the first axis."""
        for batch in batches:
            lead = (_unit(_matrix(batch.column(1), len(axes))) @ axes[:, 0] if batch.num_rows else np.zeros(0))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lead)],
                                             names=["id", "vector", "lead"])
    return run


def _suffix_norms(x: np.ndarray) -> list[np.ndarray]:
    return [np.sqrt((x[:, k:] * x[:, k:]).sum(axis=1)) for k in STEPS]


def similar_pairs(a: np.ndarray, b: np.ndarray, axes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) with a cosine of at least THRESHOLD, a strip of rows at a time.

    Rotation keeps products.  The product over the leading dimensions plus the
    product of the norms of the rest bounds the cosine from above: where that is
    below the threshold the pair is done.  What survives every step is compared
    in full, in double precision, on the vectors as given.
    """
    ua, ub = _unit(a), _unit(b)
    ra, rb = ((u @ axes).astype(np.float32) for u in (ua, ub))
    na, nb = _suffix_norms(ra), _suffix_norms(rb)
    least = THRESHOLD - TOLERANCE
    lead = min(STEPS[0], ra.shape[1])
    for at in range(0, len(a), STRIP):
        rows = slice(at, at + STRIP)
        bound = ra[rows, :lead] @ rb[:, :lead].T
        bound += na[0][rows, None] * nb[0][None, :]
        i, j = np.nonzero(bound >= least)
        i = i + at
        for k in range(0, len(i), PAIRS):
            x, y = i[k:k + PAIRS], j[k:k + PAIRS]
            for step, dims in enumerate(STEPS[1:], start=1):
                part = np.einsum("ij,ij->i", ra[x, :dims], rb[y, :dims])
                alive = part + na[step][x] * nb[step][y] >= least
                x, y = x[alive], y[alive]
            cosine = np.einsum("ij,ij->i", ua[x], ub[y])
            linked = cosine >= THRESHOLD
            if linked.any():
                yield x[linked], y[linked]


def _tile(axes: np.ndarray) -> Callable:
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        """One tile -> (node, links, root): links of each node in it, and the least node it is joined to."""
        same = key[0].as_py() == key[1].as_py()
        left = rows.filter(rows.column("left")).combine_chunks()
        right = left if same else rows.filter(pa.compute.invert(rows.column("left"))).combine_chunks()
        if not left.num_rows or not right.num_rows:
            return pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        a, b = (_matrix(t.column("vector").combine_chunks(), len(axes)) for t in (left, right))
        node = np.concatenate([left.column("node").to_numpy(), [] if same else right.column("node").to_numpy()]).astype(np.int64)
        shift = 0 if same else len(a)
        links, root = np.zeros(len(node), dtype=np.int64), np.arange(len(node))
        for i, j in similar_pairs(a, b, axes):
            if same:
                i, j = i[i < j], j[i < j]
            j = j + shift
            links += np.bincount(i, minlength=len(node)) + np.bincount(j, minlength=len(node))
            _join(root, i, j)
        held = links > 0
        least = np.full(len(node), np.iinfo(np.int64).max)
        np.minimum.at(least, root, node)
        return pa.table({"node": node[held], "links": links[held], "root": least[root][held]})
    return run


def _join(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the trees of the linked positions; afterwards every position points to its root."""
    while True:
        x, y = root[i], root[j]
        if (x == y).all():
            return
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Link all vectors whose cosine is THRESHOLD or more, and group what is linked.

    Returns one row per input row: ``id_col``, ``n_links`` (other rows linked
    directly), ``component_id`` (least id reachable over links) and ``kept`` (the
    row's id is the component's).

    The vectors are rotated to their principal axes, ordered by the first one and
    cut into blocks of equal size.  Cosine 0.9 leaves two unit vectors at most
    sqrt(0.2) apart on any axis, so a block meets only the blocks in reach.  A
    tile of two blocks accumulates the leading dimensions first and stops where
    the bound by the suffix norms cannot reach the threshold (see
    ``similar_pairs``).  It returns link counts and a spanning forest, a row per
    vector at most, never the pairs.  The vectors in reach are all compared:
    without structure in the data the work grows with their square.

    A vector that is NULL, empty or zero, or holds a NULL or a number that is not
    finite, links with nothing; so do vectors of different lengths.  A NULL id never
    names a component (one of NULL ids alone has a NULL ``component_id`` and is
    kept); rows that share an id are vectors of their own.  An empty table gives
    an empty result; other columns are ignored.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"),
                          F.when(_usable(F.col(vector_col)), F.size(vector_col)).otherwise(F.lit(0)).alias("dim"))
    out = rows.filter("dim = 0").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    for dim in sorted(r["dim"] for r in rows.filter("dim > 0").select("dim").distinct().collect()):
        out = out.unionByName(_link_dim(rows.filter(F.col("dim") == dim).drop("dim"), dim))
    return out.select(F.col("id").alias(id_col), "n_links", F.col("component").alias("component_id"),
                      F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def _link_dim(rows: DataFrame, dim: int) -> DataFrame:
    axes = principal_axes(rows, dim)
    types = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("id", "vector"))
    ranked = prefix_sums(map_arrow(rows, _lead_batches(axes), f"{types}, lead double"), ["lead"], name="vector-order")
    placed = stage(ranked.select("id", F.col("_rank").alias("node"), "vector", "lead",
                                 F.floor(F.col("_rank") / BLOCK).cast("int").alias("block")), "vector-blocks")
    # a row per block: the blocks that start within reach of its end
    blocks = placed.groupBy("block").agg(F.min("lead").alias("lo"), F.max("lead").alias("hi"))
    reach = float(np.sqrt(2 - 2 * THRESHOLD)) + 1e-9
    widest = blocks.agg(F.max(F.col("hi") - F.col("lo"))).first()[0]
    nano = 1e9                                     # a range frame counts in whole numbers
    ahead = (Window.orderBy(F.floor(F.col("lo") * nano))
             .rangeBetween(Window.currentRow, int((widest + reach) * nano) + 2))
    last = blocks.select("block", F.greatest("block", F.max("block").over(ahead)).alias("last"))
    pairs = stage(last.select(F.col("block").alias("i"), F.explode(F.sequence("block", "last")).alias("j")), "vector-tiles")
    left = placed.join(pairs, placed["block"] == pairs["i"]).select("i", "j", F.lit(True).alias("left"), "node", "vector")
    right = (placed.join(pairs.filter("i < j"), placed["block"] == F.col("j"))
             .select("i", "j", F.lit(False).alias("left"), "node", "vector"))
    tiles = left.unionByName(right).groupBy("i", "j").applyInArrow(_tile(axes), "node long, links long, root long")
    found = stage(tiles, "vector-links")
    comps = connected_components(found.select(F.col("node").alias("u"), F.col("root").alias("v")), "vector-comps")
    counts = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    labelled = (placed.select("id", "node").join(counts, "node", "left").join(comps, "node", "left")
                .withColumn("comp", F.coalesce("comp", "node")))
    least = labelled.groupBy("comp").agg(F.min("id").alias("component"))
    return (labelled.join(reshuffled(least, "comp"), "comp")
            .select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component"))
