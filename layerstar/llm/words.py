"""Words of many texts at once, as 64-bit hashes, with numpy over Arrow buffers.

Both word rules in use split at ASCII characters only, so they work on the UTF-8
bytes.  A word's hash is a polynomial in its lower-cased (A-Z) bytes, mixed; a
run of words is a polynomial in the word hashes, mixed.  Texts are taken a few
hundred kilobytes at a time, a longer text in pieces between its words, so memory
does not grow with the batch and hardly with a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Texts are worked on in groups of about so many bytes (one text at least).
GROUP_BYTES = 1 << 19

_BASE = 0x9E3779B97F4A7C15 | 1      # odd, so that it has an inverse mod 2**64
_RUN = 0xC2B2AE3D27D4EB4F | 1
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_ascii = np.arange(256)
#: ``[^\x20\x09-\x0D]+``
SPACED = ~((_ascii == 0x20) | ((_ascii >= 0x09) & (_ascii <= 0x0D)))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z
ALNUM = (((_ascii >= 0x30) & (_ascii <= 0x39)) | ((_ascii >= 0x61) & (_ascii <= 0x7A))
         | ((_ascii >= 0x41) & (_ascii <= 0x5A)) | (_ascii >= 0x80))
_LOWER = np.where((_ascii >= 0x41) & (_ascii <= 0x5A), _ascii + 32, _ascii).astype(np.uint64) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        p = np.full(n, base, dtype=np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


@dataclass
class Words:
    """Words of the texts of one group: text i has words first[i] .. first[i+1]-1."""

    row: int                 # position of the group's first text in the batch
    first: np.ndarray        # int64, one more than texts
    hash: np.ndarray         # uint64 per word
    begin: np.ndarray        # byte position of each word in ``data``
    end: np.ndarray
    data: np.ndarray         # the group's bytes
    text_at: np.ndarray      # byte position of each text, one more than texts

    def __len__(self) -> int:
        return len(self.first) - 1


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(where each text begins, one more than texts; the bytes) of an Arrow string array."""
    texts = texts.cast(pa.large_string()).fill_null("")
    at = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    buf = texts.buffers()[2]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return at, data


def word_groups(texts: pa.Array, kept: np.ndarray) -> Iterator[Words]:
    """The words of every text of an Arrow string array; NULL has none."""
    if len(texts) == 0:
        return
    at, data = text_bytes(texts)
    row = 0
    while row < len(texts):
        stop = int(np.searchsorted(at, at[row] + GROUP_BYTES, side="right")) - 1
        stop = min(max(stop, row + 1), len(texts))
        part = data[at[row]:at[stop]]
        if len(part) <= GROUP_BYTES:
            yield _words(row, at[row:stop + 1] - at[row], part, kept)
        else:
            yield _long_text(row, part, kept)
        row = stop


def _long_text(row: int, data: np.ndarray, kept: np.ndarray) -> Words:
    """One text beyond GROUP_BYTES, in pieces that end between words."""
    pieces, at = [], 0
    while at < len(data):
        stop = at + GROUP_BYTES
        while stop < len(data) and kept[data[stop]]:        # to the next separator
            ahead = np.flatnonzero(~kept[data[stop:stop + GROUP_BYTES]])
            stop += int(ahead[0]) if len(ahead) else GROUP_BYTES
        stop = min(stop, len(data))
        w = _words(row, np.array([0, stop - at]), data[at:stop], kept)
        pieces.append((w.hash, w.begin + at, w.end + at))
        at = stop
    value, begin, end = (np.concatenate(x) for x in zip(*pieces, strict=True))
    return Words(row, np.array([0, len(value)]), value, begin, end, data, np.array([0, len(data)]))


def _words(row: int, at: np.ndarray, data: np.ndarray, kept: np.ndarray) -> Words:
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    inside[1:-1] = kept[data]
    here, before, after = inside[1:-1], inside[:-2].copy(), inside[2:].copy()
    cut = at[:-1][at[:-1] < n]           # texts begin here: no word crosses
    before[cut] = False
    after[cut[cut > 0] - 1] = False
    begin = np.flatnonzero(here & ~before)
    end = np.flatnonzero(here & ~after) + 1
    first = np.searchsorted(begin, at).astype(np.int64)
    return Words(row, first, word_hashes(data, begin, end), begin, end, data, at)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words from ``begin`` to ``end``, some GROUP_BYTES at a time."""
    out, i = np.zeros(len(begin), dtype=np.uint64), 0
    while i < len(begin):
        j = max(i + 1, int(np.searchsorted(end, begin[i] + GROUP_BYTES, side="right")))
        part = data[begin[i]:end[j - 1]]
        n = len(part)
        power, inverse = _powers(max(20, n.bit_length()))
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_LOWER[part] * power[:n], out=sums[1:])
        a, b = begin[i:j] - begin[i], end[i:j] - begin[i]
        out[i:j] = (sums[b] - sums[a]) * inverse[a]
        i = j
    return mix(out)


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` consecutive values, by first position."""
    m = len(hashes) - length + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(m, dtype=np.uint64)
    q = 1
    for j in range(length):
        out += hashes[j:j + m] * np.uint64(q)
        q = q * _RUN % (1 << 64)
    return mix(out + np.uint64(length))


def shingles(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first[i] .. first[i+1]-1 per text) of all runs of ``length`` words.

    A text of fewer words, but not none, has its whole sequence as the only one.
    """
    n = np.diff(words.first)
    count = np.where(n >= length, n - length + 1, (n > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(count)])
    runs = run_hashes(words.hash, length)
    full = np.repeat(n >= length, count)
    at = np.repeat(words.first[:-1], count) + (np.arange(first[-1]) - np.repeat(first[:-1], count))
    out = np.zeros(first[-1], dtype=np.uint64)
    out[full] = runs[at[full]]
    for i in np.flatnonzero((n > 0) & (n < length)):
        out[first[i]] = run_hashes(words.hash[words.first[i]:words.first[i + 1]], int(n[i]))[0]
    return out, first
