"""Quality classifier: attention-based multiple-instance learning over passages."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerstar.llm import words as W
from layerstar.llm.common import map_arrow, one_text, stage

#: Words of a passage.
PASSAGE = 64
#: The model learns from so many labelled documents at most, those of the least key hash.
SAMPLE = 4000
#: Width of the passage encoding and of the attention.
ENCODED, ATTENTION = 16, 8
EPOCHS, RATE, DECAY, SEED = 300, 0.02, 1e-4, 11

_ascii = np.arange(256)
_punctuation = (_ascii < 0x80) & (_ascii > 0x20) & ~(
    ((_ascii >= 0x30) & (_ascii <= 0x39)) | ((_ascii >= 0x41) & (_ascii <= 0x5A)) | ((_ascii >= 0x61) & (_ascii <= 0x7A)))
_named = np.isin(_ascii, [ord(c) for c in ".,;:?'\"-()"])
#: Classes of bytes whose shares describe a passage.
_CLASSES = {
    "upper": (_ascii >= 0x41) & (_ascii <= 0x5A),
    "lower": (_ascii >= 0x61) & (_ascii <= 0x7A),
    "digit": (_ascii >= 0x30) & (_ascii <= 0x39),
    "other_script": _ascii >= 0x80,
    "line_end": _ascii == 10,
    "stop": _ascii == ord("."),
    "comma": _ascii == ord(","),
    "exclamation": _ascii == ord("!"),
    "symbol": _punctuation & ~_named & (_ascii != ord("!")),
}
FEATURES = (*_CLASSES, "words", "word_length", "short_words", "long_words", "bare_symbols", "shouted", "capitalised",
            "same_as_last", "distinct", "said_before", "empty")


def passage_features(g: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """(features, first): text i has passages first[i] .. first[i+1]-1, one at least.

    A text without words has one passage, all zeros but for ``empty``.
    """
    n = np.diff(g.first)
    count = np.maximum(1, -(-n // PASSAGE))
    first = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros((first[-1], len(FEATURES)))
    text = np.repeat(np.arange(len(g)), count)
    start = g.first[text] + (np.arange(first[-1]) - first[text]) * PASSAGE
    stop = np.minimum(start + PASSAGE, g.first[text + 1])
    full = stop > start
    out[~full, -1] = 1.0
    start, stop = start[full], stop[full]
    if not len(start):
        return out, first
    size = (stop - start).astype(float)
    from_byte, to_byte = g.begin[start], g.end[stop - 1]
    length = (to_byte - from_byte).astype(float)
    columns = [_between(flags[g.data], from_byte, to_byte) / length for flags in _CLASSES.values()]

    chars = g.end - g.begin
    head = g.data[g.begin]
    upper = _sums(_CLASSES["upper"][g.data])
    letters = upper + _sums(_CLASSES["lower"][g.data]) + _sums(_CLASSES["other_script"][g.data])
    uppers, lettered = (s[g.end] - s[g.begin] for s in (upper, letters))
    owner = np.repeat(np.arange(len(g)), n)
    same = np.zeros(len(g.hash), dtype=bool)
    same[1:] = (g.hash[1:] == g.hash[:-1]) & (owner[1:] == owner[:-1])
    place = np.repeat(np.arange(len(start)), stop - start)
    fresh_here = _first_seen(g.hash, place)
    runs = W.run_hashes(g.hash, 3)
    inside = owner[:len(runs)] == owner[len(g.hash) - len(runs):] if len(runs) else np.zeros(0, bool)
    before = np.zeros(len(g.hash), dtype=bool)
    before[:len(runs)] = ~_first_seen(runs, owner[:len(runs)]) & inside
    columns += [size / PASSAGE, length / size / 10]
    columns += [_between(x, start, stop) / size for x in (
        chars <= 2, chars > 14, lettered == 0, (uppers == lettered) & (uppers > 1), _CLASSES["upper"][head],
        same, fresh_here, before)]
    out[full, :-1] = np.stack(columns, axis=1)
    return out, first


def _sums(flags: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])


def _between(flags: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    s = _sums(flags)
    return (s[stop] - s[start]).astype(float)


def _first_seen(value: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """True where a value stands for the first time in its owner."""
    keyed = W.mix(value ^ W.mix(owner.astype(np.uint64) + np.uint64(1)))
    out = np.zeros(len(value), dtype=bool)
    out[np.unique(keyed, return_index=True)[1]] = True
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    """Passage encoder, gated attention and the classifier over the pooled encoding."""

    mean: np.ndarray
    spread: np.ndarray
    params: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        """x: standardised features; first: start of each document's passages, and the end."""
        p = self.params
        at, n = first[:-1], np.diff(first)
        h = np.tanh(x @ p["encode"] + p["encode_0"])
        t, s = np.tanh(h @ p["look"]), _sigmoid(h @ p["gate"])
        e = (t * s) @ p["weigh"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, at), n))
        a = e / np.repeat(np.add.reduceat(e, at), n)
        z = np.add.reduceat(a[:, None] * h, at)
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "score": _sigmoid(z @ p["read"] + p["read_0"][0])}

    def standardised(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.mean) / self.spread, -8, 8)

    def scores(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.forward(self.standardised(features), first)["score"]


def _gradients(model: Model, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean cross-entropy by back-propagation through the attention."""
    p, f, n = model.params, model.forward(x, first), np.diff(first)
    h, t, s, a = f["h"], f["t"], f["s"], f["a"]
    d = (f["score"] - y) / len(y)
    dz = np.repeat(d[:, None] * p["read"][None, :], n, axis=0)     # of each passage's document
    da = (dz * h).sum(axis=1)
    de = a * (da - np.repeat(np.add.reduceat(a * da, first[:-1]), n))
    dt, ds = de[:, None] * p["weigh"] * s * (1 - t * t), de[:, None] * p["weigh"] * t * s * (1 - s)
    dh = (a[:, None] * dz + dt @ p["look"].T + ds @ p["gate"].T) * (1 - h * h)
    return {"encode": x.T @ dh, "encode_0": dh.sum(axis=0), "look": h.T @ dt, "gate": h.T @ ds,
            "weigh": (t * s).T @ de, "read": f["z"].T @ d, "read_0": np.array([d.sum()])}


def train(features: list[np.ndarray], labels: list[int]) -> Model | None:
    """Learn encoder, attention and classifier from document labels alone (Adam, full batches)."""
    if not labels:
        return None
    x, y = np.vstack(features), np.asarray(labels, dtype=float)
    first = np.concatenate([[0], np.cumsum([len(f) for f in features])])
    rng = np.random.default_rng(SEED)
    shapes = {"encode": (len(FEATURES), ENCODED), "encode_0": (ENCODED,), "look": (ENCODED, ATTENTION),
              "gate": (ENCODED, ATTENTION), "weigh": (ATTENTION,), "read": (ENCODED,), "read_0": (1,)}
    params = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) if not k.endswith("_0") else np.zeros(s) for k, s in shapes.items()}
    model = Model(x.mean(axis=0), x.std(axis=0) + 1e-3, params)
    x = model.standardised(x)
    m, v = ({k: np.zeros(s) for k, s in shapes.items()} for _ in range(2))
    for step in range(1, EPOCHS + 1):
        for k, g in _gradients(model, x, first, y).items():
            g = g + DECAY * params[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            params[k] -= RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rank, label, text) -> (rank, label, features of its passages, row after row)."""
    for batch in batches:
        for g in W.word_groups(batch.column(2), W.SPACED):
            x, first = passage_features(g)
            flat = [x[first[i]:first[i + 1]].ravel() for i in range(len(g))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(g.row, len(g)), batch.column(1).slice(g.row, len(g)),
                 pa.array(flat, pa.list_(pa.float64()))], names=["rank", "label", "features"])


def fit(docs: DataFrame, labels: DataFrame, key_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> Model | None:
    """Learn from at most SAMPLE labelled documents; ``labels`` is (key_col, label_col), 0 or 1.

    Only features of the sampled texts reach the driver.  NULL keys and labels
    are left out; a document with several labels counts with each.  Of rows that
    share a key the one of least text hash counts, so no more than SAMPLE texts come.
    """
    rank = F.xxhash64(key_col)
    picked = stage(labels.filter(F.col(key_col).isNotNull() & F.col(label_col).isNotNull())
                   .select(F.col(key_col).alias("_key"), F.col(label_col).cast("int").alias("_label"), rank.alias("_rank"))
                   .orderBy("_rank", "_label").limit(SAMPLE), "quality-sample")
    texts = one_text(docs.select(F.col(key_col).alias("_key"), F.col(text_col).alias("_text"))
                     .join(picked.select("_key").distinct(), "_key"), "_key")
    rows = texts.join(picked, "_key").select("_rank", "_label", "_text")
    found = map_arrow(rows, _feature_batches, "rank long, label int, features array<double>").collect()
    found.sort(key=lambda r: (r["rank"], r["label"], r["features"]))
    return train([np.array(r["features"]).reshape(-1, len(FEATURES)) for r in found], [r["label"] for r in found])


def _score_batches(model: Model | None, text: int, score_col: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The batch's columns, the one at ``text`` being the text, and the score."""
        for batch in batches:
            for g in W.word_groups(batch.column(text), W.SPACED):
                score = model.scores(*passage_features(g)) if model is not None else np.full(len(g), 0.5)
                yield pa.RecordBatch.from_arrays([*(c.slice(g.row, len(g)) for c in batch.columns), pa.array(score)],
                                                 names=[*batch.schema.names, score_col])
    return run


def with_score(docs: DataFrame, model: Model | None, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the likelihood of label 1 of every whole text in ``score_col``.

    Every passage of PASSAGE words is encoded; a gated attention weighs the
    encodings and the weighted mean gives the score.  NULL and empty texts have
    one empty passage and its score; where nothing could be learned every score
    is 0.5.  Keys may be NULL or repeat; an empty table gives an empty result; a
    column that is called ``score_col`` already is replaced.
    """
    slim = docs.drop(score_col)
    types = ", ".join(f"`{c}` {kind}" for c, kind in slim.dtypes)
    return map_arrow(slim, _score_batches(model, slim.columns.index(text_col), score_col), f"{types}, `{score_col}` double")
