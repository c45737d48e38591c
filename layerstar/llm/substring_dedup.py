"""Removal of repeated passages by sliding spans of sentences."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerstar.llm import words as W
from layerstar.llm.common import map_arrow, reshuffled, stage

#: A span is the shortest run of at least SENTENCES sentences and MIN_WORDS words.  The contract wants no
#: repeated run of 50 words left.  In a repeated run, cuts are the same in every copy from 2 WINDOW - 1 = 9
#: words after its begin to as many before its end, and no piece is over LONG_SENTENCE = 8 words.  So a span
#: that starts at the first of them ends within MIN_WORDS + 7 words: 9 + 9 + 24 + 7 = 49 words always hold one.
SENTENCES, MIN_WORDS = 3, 24
#: A longer sentence is cut after the word of least hash of every WINDOW in a row, so that a passage
#: put into the middle of another sentence still falls into the same pieces.
LONG_SENTENCE = 8
#: Scripts without spaces: so many bytes count as a word, and a longer run is cut into words after the
#: code point of least hash of every WINDOW in a row.
WORD_BYTES, WINDOW = 16, 5
#: Code points of such scripts (Thai to Tibetan, Myanmar, Khmer, kana and Han, full-width forms), their
#: full stops, and what may close a quotation after one.
_UNSPACED = ((0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x9FFF), (0xF900, 0xFAFF), (0xFF00, 0xFFEF),
             (0x20000, 0x3FFFF))
_WIDE_ENDS = np.array([ord(c) for c in "。！？．｡"])
_WIDE_CLOSES = np.array([ord(c) for c in "」』”’）】》〉"])

_Q = 0xA0761D6478BD642F | 1
_ends = np.zeros(256, dtype=bool)
_ends[[ord(c) for c in ".!?"]] = True
_closes = np.zeros(256, dtype=bool)
_closes[[ord(c) for c in "\"')]}"]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _q(n: int) -> list[np.ndarray]:
    """Powers of _Q and of its inverse, up to n at least."""
    if len(_powers[0]) <= n:
        size = 1 << (n + 1).bit_length()
        for k, base in enumerate((_Q, pow(_Q, -1, 1 << 64))):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers


@dataclass
class Sentences:
    """Sentences of one group of texts: text i has sentences first[i] .. first[i+1]-1."""

    words: W.Words
    word: np.ndarray        # first word of each sentence, and the word count at the end
    first: np.ndarray


def least_of_windows(value: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Whether each value is the least (the last such) of any WINDOW in a row of its group.

    Of any WINDOW in a row one is, and which ones depends on the WINDOW - 1 values to both sides alone.
    """
    out, m = np.zeros(len(value), dtype=bool), len(value) - WINDOW + 1
    if m > 0:
        least, at = value[:m].copy(), np.arange(m)
        for j in range(1, WINDOW):
            less = value[j:j + m] <= least
            least[less], at[less] = value[j:j + m][less], np.flatnonzero(less) + j
        out[at[group[:m] == group[WINDOW - 1:]]] = True
    return out


def cut_unspaced(g: W.Words) -> tuple[W.Words, np.ndarray]:
    """The words with long runs in scripts without spaces cut, and whether each ends at a full-width stop."""
    d, none = g.data, np.zeros(len(g.hash), dtype=bool)
    at = np.flatnonzero(d >= 0xE0)                 # code points of three bytes and four
    if not len(at):
        return g, none
    four = d[at] >= 0xF0
    b = [d[np.minimum(at + k, len(d) - 1)].astype(np.int64) & 0x3F for k in range(4)]
    code = np.where(four, (b[0] & 7) << 18 | b[1] << 12 | b[2] << 6 | b[3], (b[0] & 15) << 12 | b[1] << 6 | b[2])
    unspaced = np.zeros(len(at), dtype=bool)
    for low, high in _UNSPACED:
        unspaced |= (code >= low) & (code <= high)
    stop, close = np.isin(code, _WIDE_ENDS), np.isin(code, _WIDE_CLOSES)
    if not unspaced.any():
        return g, none
    after = at + 3 + four
    word = np.searchsorted(g.begin, at, side="right") - 1
    joined = np.append((after[:-1] == at[1:]) & (word[:-1] == word[1:]), False)
    ends = stop.copy()                             # the last of a run of stops, with what closes after it
    ends[1:] |= close[1:] & stop[:-1] & joined[:-1]
    ends[:-1] &= ~(joined[:-1] & (stop[1:] | close[1:] & stop[:-1]))
    before = np.where(np.append(False, joined[:-1]), np.append(0, code[:-1]), 0)
    value = W.mix((before << 21 | code).astype(np.uint64))
    long = unspaced & ((g.end - g.begin)[word] > WORD_BYTES)
    cut = np.zeros(len(at), dtype=bool)
    cut[long] = least_of_windows(value[long], word[long])
    inner = after[(cut | ends) & (after < g.end[word])]
    begin = np.sort(np.concatenate([g.begin, inner]))
    end = np.sort(np.concatenate([g.end, inner]))
    cut_words = W.Words(g.row, np.searchsorted(begin, g.text_at).astype(np.int64), W.word_hashes(d, begin, end), begin, end,
                        d, g.text_at)
    return cut_words, np.isin(end, after[ends])


def split_sentences(g: W.Words) -> Sentences:
    """Sentences end at . ! or ? before white space, at a full-width stop, at a line end and at the text's end."""
    g, wide = cut_unspaced(g)
    n = len(g.hash)
    last = g.data[g.end - 1] if n else np.zeros(0, np.uint8)
    end = _ends[last]
    quoted = np.flatnonzero(_closes[last] & (g.end - g.begin > 1))
    end[quoted] |= _ends[g.data[g.end[quoted] - 2]]
    end |= wide
    lines = np.concatenate([[0], np.cumsum(g.data == 10)])
    if n:
        end[:-1] |= lines[g.begin[1:]] > lines[g.end[:-1]]
    closing = g.first[1:][np.diff(g.first) > 0] - 1
    end[closing] = True
    stops = np.flatnonzero(end) + 1
    length = np.diff(np.concatenate([[0], stops]))
    in_long = np.repeat(length > LONG_SENTENCE, length)
    end |= in_long & least_of_windows(g.hash, np.repeat(np.arange(len(g)), np.diff(g.first)))
    word = np.concatenate([[0], np.flatnonzero(end) + 1])
    return Sentences(g, word, np.searchsorted(word, g.first))


def spans(s: Sentences) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, sentence in its text, sentences, hash) of every span."""
    g, m = s.words, len(s.word) - 1
    if m <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    at = np.concatenate([g.begin, [len(g.data)]])[s.word]
    weight = np.maximum(np.diff(s.word), np.diff(at) // WORD_BYTES)
    sums = np.concatenate([[0], np.cumsum(weight)])
    index = np.arange(m)
    stop = np.maximum(np.searchsorted(sums, sums[:-1] + MIN_WORDS), index + SENTENCES)
    text = np.searchsorted(s.first, index, side="right") - 1
    fits = stop <= s.first[text + 1]
    a, b = s.word[index[fits]], s.word[stop[fits]]
    power, inverse = _q(len(g.hash))
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(g.hash * power[:len(g.hash)])])
    value = W.mix((run[b] - run[a]) * inverse[a] + (b - a).astype(np.uint64))
    return text[fits], index[fits] - s.first[text[fits]], (stop - index)[fits], value


def _span_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, check, text) -> a row per span."""
    for batch in batches:
        for g in W.word_groups(batch.column(2), W.SPACED):
            text, at, n, value = spans(split_sentences(g))
            take = pa.array(text + g.row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(at.astype(np.int32)),
                 pa.array(n.astype(np.int32)), pa.array(value.view(np.int64))],
                names=["id", "check", "at", "n", "span"])


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, text, at, n) -> (row, text without the spans, sentences, sentences removed)."""
    for batch in batches:
        for g in W.word_groups(batch.column(1), W.SPACED):
            s = split_sentences(g)
            rows = slice(g.row, g.row + len(g))
            texts = batch.column(1)[rows]
            starts, counts = batch.column(2)[rows], batch.column(3)[rows]
            total = np.diff(s.first)
            new, removed = texts.to_pylist() if starts.null_count < len(g) else None, np.zeros(len(g), np.int64)
            for i in np.flatnonzero(starts.is_valid().to_numpy(zero_copy_only=False)):
                gone = np.zeros(total[i] + 1, dtype=np.int64)
                at, n = np.asarray(starts[i].as_py()), np.asarray(counts[i].as_py())
                np.add.at(gone, at, 1)
                np.add.at(gone, at + n, -1)
                gone = np.cumsum(gone)[:-1] > 0
                removed[i] = gone.sum()
                edge = s.words.begin[s.word[s.first[i]:s.first[i + 1]]].copy()
                edge[0] = g.text_at[i]
                edge = np.append(edge, g.text_at[i + 1])
                kept = b"".join(g.data[edge[j]:edge[j + 1]].tobytes() for j in np.flatnonzero(~gone))
                new[i] = kept.decode("utf-8").rstrip() if gone[-1] else kept.decode("utf-8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[rows], texts if new is None else pa.array(new, pa.string()),
                 pa.array(total.astype(np.int64)), pa.array(removed)],
                names=["_row", "_text", "_sentences", "_removed"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   count_cols: tuple[str, str] = ("n_sentences", "n_removed")) -> DataFrame:
    """Remove the sentences that a repeated span covers, except where the span comes first.

    Returns every input row and column, ``text_col`` without the removed
    sentences, plus the number of sentences and of those removed (``count_cols``;
    columns of these names in the input are replaced).  A span is the shortest run of consecutive sentences, from each sentence
    on, of at least SENTENCES sentences and MIN_WORDS words; its words are
    compared with A-Z lower-cased and white space ignored.  A long run of a script
    without spaces is cut into words of about three characters by its own content.
    Every repeated run of 49 words holds a span, whatever stands around its copies.  Spans of all
    documents are joined by hash; of equal spans the first by (id, sentence)
    stays.  Spans of one document count as well.  A text without repeats stays
    as it is, byte by byte.

    NULL texts stay NULL and have 0 sentences; a text whose every sentence goes
    is empty.  NULL ids come last; rows that share id and text are one document
    and keep the same sentences, rows that share an id only are told apart by
    their texts.  An empty table gives an empty result.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("check"),
                        F.col(text_col).alias("text"))
    every = map_arrow(keyed, _span_batches, f"id {id_type}, check long, at int, n int, span long")
    # first by hash alone: most spans occur once and go no further.  Each step is stored, so that the
    # shuffle files of one are gone before the next one writes its own
    counts = every.groupBy("span").agg(F.count(F.lit(1)).alias("_n"))
    repeated = stage(counts.filter("_n > 1").select("span"), "repeated")
    found = stage(every.join(reshuffled(repeated, "span"), "span"), "repeat-spans")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "at", "check")
    first = found.groupBy("span").agg(F.min(place).alias("first"))
    later = found.join(reshuffled(first, "span"), "span").filter(~place.eqNullSafe(F.col("first")))
    marks = (later.groupBy("id", "check").agg(F.collect_set(F.struct("at", "n")).alias("_spans"))
             .select(F.col("id").alias("_id"), F.col("check").alias("_check"),
                     F.col("_spans.at").alias("_at"), F.col("_spans.n").alias("_len")))
    marks = stage(marks, "repeat-marks")
    rows = docs.select(F.struct("*").alias("_row"), F.xxhash64(text_col).alias("_hash"))
    key = F.col(f"_row.`{id_col}`").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_check"))
    joined = rows.join(marks, key, "left").select("_row", F.col(f"_row.`{text_col}`").alias("_text"), "_at", "_len")
    slim = joined.withColumn("_row", F.col("_row").withField(text_col, F.lit(None).cast("string")))
    row_type = slim.schema["_row"].dataType.simpleString()
    cut = map_arrow(slim, _cut_batches, f"_row {row_type}, _text string, _sentences long, _removed long")
    names = [c for c in docs.columns if c not in count_cols]
    return cut.select(*[F.col("_text").alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in names],
                      F.col("_sentences").alias(count_cols[0]), F.col("_removed").alias(count_cols[1]))
