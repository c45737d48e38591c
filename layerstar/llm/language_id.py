"""Language identification with a blended-spectrum string kernel."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerstar.llm import words as W
from layerstar.llm.common import map_arrow, one_text, stage

#: n-grams of these many bytes (A-Z lower-cased, every run of other ASCII characters one space).
GRAMS = (1, 2, 3, 4)
#: An n-gram counts by its presence, in one of so many hashed places.
PLACES = 1 << 17
#: The model learns from SAMPLE texts of each language at most, LANDMARKS of them landmarks; with
#: many languages from so many that there are about SAMPLE_ALL and LANDMARKS_ALL of all languages together.
SAMPLE, LANDMARKS = 256, 48
SAMPLE_ALL, LANDMARKS_ALL = 4096, 1024
RIDGE = 1e-3
#: Steepness of the softmax that turns one-versus-rest scores into a confidence.
SLOPE = 4.0
UNDETERMINED = "und"

_ascii = np.arange(256)
_letter = (((_ascii >= 0x41) & (_ascii <= 0x5A)) | ((_ascii >= 0x61) & (_ascii <= 0x7A)) | (_ascii >= 0x80))
_folded = np.where(_letter, np.where(_ascii < 0x5B, _ascii | 0x20, _ascii), 0x20).astype(np.uint32)
_SPREAD = np.uint32(2654435761)


def present_grams(text: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Places of the n-grams present in the bytes of one text, in rising order.

    ``seen`` is an all-false scratch array of PLACES flags; it is left all false.
    """
    if not len(text):
        return np.zeros(0, dtype=np.int64)
    code = _folded[text]
    blank = code == 0x20
    code = np.concatenate([[np.uint32(0x20)], code[~(blank & np.concatenate([[True], blank[:-1]]))], [np.uint32(0x20)]])
    value = np.zeros(len(code), dtype=np.uint32)
    for n in range(1, GRAMS[-1] + 1):
        if len(code) < n:
            break
        value = (value[:len(code) - n + 1] << np.uint32(8)) | code[n - 1:]
        if n in GRAMS:
            mixed = (value + np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * _SPREAD
            mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            seen[(mixed >> np.uint32(15)).astype(np.int64)] = True
    out = np.flatnonzero(seen)
    seen[out] = False
    return out


def _each_text(texts: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of every text of an Arrow array; NULL has none."""
    at, data = W.text_bytes(texts)
    for i in range(len(texts)):
        yield data[at[i]:at[i + 1]]


def _sample_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> (lang, places): at most PLACES numbers however long the text."""
    seen = np.zeros(PLACES, dtype=bool)
    for batch in batches:
        places = [present_grams(t, seen) for t in _each_text(batch.column(1))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([p.astype("<i4").tobytes() for p in places], pa.binary())], names=["lang", "places"])


@dataclass
class Model:
    """One weight per place and language, and the languages' offsets."""

    langs: list[str]
    weights: np.ndarray
    offset: np.ndarray

    def scores(self, places: list[np.ndarray]) -> np.ndarray:
        """One-versus-rest scores of each text: X (L C) / sqrt(n) + offset.

        X is the batch's sparse presence matrix, L the landmarks' and C the
        coefficients; (X L) C is the kernel with every landmark times its weight,
        and L C is the same for every batch.
        """
        n = np.array([len(p) for p in places])
        out = np.tile(self.offset, (len(places), 1))
        has = n > 0
        if has.any():
            flat = np.concatenate([p for p in places if len(p)])
            first = np.concatenate([[0], np.cumsum(n[has])[:-1]])
            out[has] += np.add.reduceat(self.weights[flat], first, axis=0) / np.sqrt(n[has])[:, None]
        return out


def train(langs: list[str], places: list[np.ndarray]) -> Model | None:
    """Kernel ridge regression, one language against the rest, on Nyström landmarks.

    The kernel of two texts is the number of n-grams present in both over the
    geometric mean of the numbers present in each.
    """
    known = sorted(set(langs))
    if not known:
        return None
    order = {k: i for i, k in enumerate(known)}
    y = np.array([order[k] for k in langs])
    per_lang = max(1, min(LANDMARKS, LANDMARKS_ALL // len(known)))
    marks = np.concatenate([np.flatnonzero(y == i)[:per_lang] for i in range(len(known))])
    size = np.array([max(1, len(p)) for p in places], dtype=float)
    # the n-grams a landmark shares with every text, counted over the texts' lists one after another
    has = np.array([len(p) > 0 for p in places])
    flat = np.concatenate([np.asarray(p, dtype=np.int32) for p in places])
    first = np.concatenate([[0], np.cumsum([len(p) for p in places])[:-1]])[has].astype(np.int64)
    kernel, seen = np.zeros((len(places), len(marks))), np.zeros(PLACES, dtype=bool)
    for column, i in enumerate(marks):
        seen[places[i]] = True
        if has.any():
            kernel[has, column] = np.add.reduceat(seen[flat], first, dtype=np.int64) / np.sqrt(size[has] * size[i])
        seen[places[i]] = False
    values, vectors = np.linalg.eigh(kernel[marks])
    held = values > 1e-8 * values[-1]
    root = vectors[:, held] / np.sqrt(values[held])             # the landmarks' kernel to the power -1/2
    x = np.hstack([kernel @ root, np.ones((len(y), 1))])
    share = 1.0 / np.bincount(y)[y]                             # every language weighs the same
    target = np.where(y[:, None] == np.arange(len(known)), 1.0, -1.0)
    scale = np.diag(np.append(np.full(x.shape[1] - 1, RIDGE), 1e-9))
    beta = np.linalg.solve(x.T @ (x * share[:, None]) + scale, x.T @ (target * share[:, None]))
    weights = np.zeros((PLACES, len(known)), dtype=np.float32)
    for i, share_of in zip(marks, root @ beta[:-1], strict=True):
        weights[places[i]] += share_of / np.sqrt(size[i])
    return Model(known, weights, beta[-1])


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id") -> Model | None:
    """Learn from a sample of ``docs``, at most SAMPLE texts of each language.

    The texts of a language fall into SAMPLE bins by a hash of the key, and each
    bin gives the one of least hash, so the same rows give the same sample; of rows that
    share a key and a language the one of least text hash counts.  With more than
    SAMPLE_ALL / SAMPLE languages fewer bins of each are taken, at least one.  The
    executors turn the sampled texts into presence lists; those reach the driver, four
    bytes a place.
    """
    rank = F.xxhash64(key_col)
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(key_col).isNotNull())
    picked = (known.groupBy(F.col(lang_col).alias("_lang"), F.pmod(rank, F.lit(SAMPLE)).alias("_bin"))
              .agg(F.min(F.struct(rank.alias("rank"), F.col(key_col).alias("key"))).alias("_least"))
              .select("_lang", "_bin", F.col("_least.key").alias("_key")))
    picked = stage(picked, "language-sample")
    langs = picked.select("_lang").distinct().count()
    place = F.row_number().over(Window.partitionBy("_lang").orderBy("_bin"))
    picked = picked.withColumn("_place", place).filter(F.col("_place") <= max(1, min(SAMPLE, SAMPLE_ALL // max(1, langs))))
    joined = (known.join(picked, (F.col(key_col) == F.col("_key")) & (F.col(lang_col) == F.col("_lang")))
              .select("_lang", "_key", F.col(text_col).alias("_text")))
    texts = one_text(joined, "_lang", "_key").select("_lang", "_text")
    rows = map_arrow(texts, _sample_batches, "lang string, places binary").collect()
    found = sorted(((r["lang"], np.frombuffer(r["places"], "<i4")) for r in rows), key=lambda r: (r[0], r[1].tolist()))
    return train([r[0] for r in found], [r[1] for r in found])


def _predict_batches(model: Model | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(text, *rest) -> (*rest, lang_pred, score)."""
        seen = np.zeros(PLACES, dtype=bool)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = batch.column(0)
                lettered = np.array([t is not None and any(map(str.isalpha, t)) for t in texts.to_pylist()], dtype=bool)
                lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
                if model is not None and lettered.any():
                    raw = SLOPE * model.scores([present_grams(t, seen) for t in _each_text(texts)])
                    share = np.exp(raw - raw.max(axis=1, keepdims=True))
                    share /= share.sum(axis=1, keepdims=True)
                    best = share.argmax(axis=1)
                    lang = [model.langs[b] if ok else UNDETERMINED for b, ok in zip(best, lettered, strict=True)]
                    score = np.where(lettered, share[np.arange(len(best)), best], 0.0)
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(lang, pa.string()), pa.array(score)],
                                                 names=[*batch.schema.names[1:], "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Language of every whole text: the columns ``keep``, ``lang_pred`` and ``score``.

    ``score`` is the language's share of the softmax over the one-versus-rest
    scores.  A NULL text and one without a letter are ``und`` with score 0, as is
    every text where nothing could be learned.  Ties go to the language that
    sorts first; keys may be NULL or repeat; an empty table gives an empty
    result; other columns are ignored.
    """
    slim = docs.select(F.col(text_col).alias("_text"), *keep)
    types = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return map_arrow(slim, _predict_batches(model), f"{types}, lang_pred string, score double")
