"""Licence scan: matching statistics over a generalised suffix automaton of licence words."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from layerstar.llm import words as W
from layerstar.llm.common import map_arrow
from layerstar.llm.license_templates import PHRASES, TEMPLATES

#: A match shorter than so many words starts or continues no chain.
LEAST_MATCH = 3
#: A chain goes on over so many words at most, in the document and in the template.
MOST_GAP = 8
#: A template is found where a chain covers so much of its words.
LEAST_COVER = 0.8

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Lower-cased (A-Z) words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of one text."""
    out = []
    for g in W.word_groups(pa.array([text]), W.ALNUM):
        out += [g.data[b:e].tobytes().translate(_LOWER) for b, e in zip(g.begin, g.end, strict=True)]
    return out


class Automaton:
    """Suffix automaton of several word sequences: its states are the sets of runs with equal ends.

    ``next``, ``link`` and ``length`` are those of the public construction; a new
    sequence begins at the root and reuses states that are there.
    """

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]      # (template, end) of the prefixes of the state itself
        self._children: list[list[int]] | None = None
        self._found: dict[int, list[tuple[int, int]]] = {}

    def _state(self, length: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        self.ends.append([])
        return len(self.next) - 1

    def _split(self, p: int, word: int) -> int:
        """The state of the longest run of ``p`` followed by ``word``, apart from longer ones."""
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, template: int, sequence: Sequence[int]) -> int:
        """Takes in one sequence; the state of the whole of it (valid until the next ``add``)."""
        last = 0
        for end, word in enumerate(sequence, 1):
            if word in self.next[last]:
                last = self._split(last, word)
            else:
                new = self._state(self.length[last] + 1, {}, 0)
                p = last
                while p >= 0 and word not in self.next[p]:
                    self.next[p][word] = new
                    p = self.link[p]
                if p >= 0:
                    self.link[new] = self._split(p, word)
                last = new
            self.ends[last].append((template, end))
        self._children = None
        self._found.clear()
        return last

    def state_of(self, sequence: Sequence[int]) -> int:
        v = 0
        for word in sequence:
            v = self.next[v][word]
        return v

    def places(self, state: int) -> list[tuple[int, int]]:
        """(template, end) of every place at which the runs of ``state`` end."""
        if self._children is None:
            self._children = [[] for _ in self.next]
            for v, parent in enumerate(self.link):
                if parent >= 0:
                    self._children[parent].append(v)
        if state not in self._found:
            out, todo = [], [state]
            while todo:
                v = todo.pop()
                out += self.ends[v]
                todo += self._children[v]
            self._found[state] = sorted(out)
        return self._found[state]

    def stream(self, sequence: Sequence[int]) -> Iterator[tuple[int, int]]:
        """Matching statistics: for each word, the state and length of the longest run that ends with it."""
        v, n = 0, 0
        for word in sequence:
            while v and word not in self.next[v]:
                v = self.link[v]
                n = self.length[v]
            if word in self.next[v]:
                v, n = self.next[v][word], n + 1
            yield v, n


@dataclass(frozen=True)
class Span:
    """Words ``first`` to ``last`` of the document, matched by a share ``cover`` of a template's words."""

    label: str
    first: int
    last: int
    cover: float


@dataclass
class Finding:
    n_words: int = 0
    starts: list[int] = field(default_factory=list)
    base: set[str] = field(default_factory=set)
    spans: list[Span] = field(default_factory=list)
    score: float = 0.0


class Scanner:
    """The automaton of all phrases and templates, and what it says about documents."""

    def __init__(self, templates: Sequence[tuple[str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES,
                 least_match: int = LEAST_MATCH, most_gap: int = MOST_GAP, least_cover: float = LEAST_COVER) -> None:
        self.least_match, self.most_gap, self.least_cover = least_match, most_gap, least_cover
        self.number: dict[bytes, int] = {}
        self.labels = [label for _, label in templates]
        sequences = [self._numbers(text) for text, _ in templates]
        self.sizes = [len(s) for s in sequences]
        self.phrases = [(self._numbers(text), label) for text, label in phrases]
        self.automaton = Automaton()
        for i, s in enumerate(sequences):
            self.automaton.add(i, s)
        for s, _ in self.phrases:
            self.automaton.add(-1, s)
        self._mark_phrases()
        self.shortest = min([self.least_match, *(len(s) for s, _ in self.phrases)])
        joined = list(self.number)
        text = b" ".join(joined)
        end = np.cumsum([len(w) + 1 for w in joined], dtype=np.int64) - 1 if joined else np.zeros(0, np.int64)
        begin = end - np.array([len(w) for w in joined], dtype=np.int64)
        self.hashes = np.sort(W.word_hashes(np.frombuffer(text, np.uint8), begin, end))

    def _numbers(self, text: str) -> list[int]:
        return [self.number.setdefault(w, len(self.number)) for w in words_of(text)]

    def _mark_phrases(self) -> None:
        """For each state the phrases that are suffixes of its longest run, from its link's on."""
        a = self.automaton
        own: dict[int, list[tuple[int, str]]] = {}
        for s, label in self.phrases:
            if s:
                own.setdefault(a.state_of(s), []).append((len(s), label))
        self.phrases_at: list[tuple[tuple[int, str], ...]] = [()] * len(a.next)
        for v in sorted(range(1, len(a.next)), key=a.length.__getitem__):
            self.phrases_at[v] = (*self.phrases_at[a.link[v]], *own.get(v, ()))

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """Whether a word may be one of the vocabulary, by its hash; the words themselves decide later."""
        if not len(self.hashes):
            return np.zeros(len(hashes), dtype=bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.hashes[at] == hashes

    def scan(self, g: W.Words) -> list[Finding]:
        """A finding per text of the group.  Words outside the vocabulary match nothing and start the automaton
        afresh, so only runs of known words are streamed, and those too short for any match are left out."""
        out = [Finding(int(n)) for n in np.diff(g.first)]
        if not len(g.hash):
            return out
        known = self.known(g.hash)
        text = np.repeat(np.arange(len(g)), np.diff(g.first))
        new = np.append(True, text[1:] != text[:-1])
        starts = np.flatnonzero(known & (new | ~np.append(False, known[:-1])))
        stops = np.flatnonzero(known & np.append(new[1:] | ~known[1:], True)) + 1
        long = stops - starts >= self.shortest
        matches: dict[int, list[tuple[int, int, int]]] = {}
        for a, b in zip(starts[long].tolist(), stops[long].tolist(), strict=True):
            i = int(text[a])
            self._run(g, a, b, int(g.first[i]), out[i], matches.setdefault(i, []))
        for i, found in matches.items():
            out[i].spans, best = self.chains(found)
            out[i].score = 1.0 if out[i].starts else best
        return out

    def _run(self, g: W.Words, a: int, b: int, zero: int, finding: Finding, found: list[tuple[int, int, int]]) -> None:
        """Streams words a to b; long matches that cannot be made longer go to ``found`` as (first, end, state)."""
        ids = [self.number.get(g.data[x:y].tobytes().translate(_LOWER), -1) for x, y in zip(g.begin[a:b], g.end[a:b], strict=True)]
        before, length = 0, 0
        for at, (v, n) in enumerate(self.automaton.stream(ids), a - zero + 1):
            if n <= length and length >= self.least_match:
                found.append((at - 1 - length, at - 1, before))
            before, length = v, n
            for size, label in self.phrases_at[v]:
                if n >= size:
                    finding.starts.append(at - size)
                    finding.base.add(label)
        if length >= self.least_match:
            found.append((b - zero - length, b - zero, before))

    def chains(self, found: list[tuple[int, int, int]]) -> tuple[list[Span], float]:
        """(the spans that cover LEAST_COVER of a template, the greatest share of any template covered).

        Matches of one template are chained in the order of both document and
        template; each takes the best chain that ends at most MOST_GAP words
        before it.  Of chains that overlap in the document the one that covers
        more words stays, then the greater share, then the earlier template.
        """
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for first, end, state in found:
            for template, stop in self.automaton.places(state):
                if template >= 0:
                    by_template.setdefault(template, []).append((first, end, stop))
        tops = [(-covered, -covered / self.sizes[t], t, first, end)
                for t in sorted(by_template) for covered, first, end in self._chains_of(sorted(by_template[t]))]
        spans, taken = [], []
        for _, share, template, first, end in sorted(tops):
            if -share >= self.least_cover and not _overlaps(taken, first, end):
                insort(taken, (first, end))
                spans.append(Span(self.labels[template], first, end - 1, -share))
        return sorted(spans, key=lambda s: (s.first, s.last, s.label)), max((-t[1] for t in tops), default=0.0)

    def _chains_of(self, matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """(words covered, first, end) of each chain that no match continues; matches are (first, end, template end).

        Matches that cannot be made longer end in the order in which they begin, so those in reach of one
        are the last few: no more than a template's length allows.
        """
        covered, first = [], []
        continued = [False] * len(matches)
        low = 0
        for i, (a, b, t) in enumerate(matches):
            best, begin, via = b - a, a, -1
            while matches[low][1] + self.most_gap < a:
                low += 1
            for j in range(low, i):
                x, y, u = matches[j]
                gain = min(b - y, t - u, b - a)
                gap = t - (b - a) - u
                if x < a and gain > 0 and u - (y - x) < t - (b - a) and gap <= self.most_gap and covered[j] + gain > best:
                    best, begin, via = covered[j] + gain, first[j], j
            covered.append(best)
            first.append(begin)
            if via >= 0:
                continued[via] = True
        return [(covered[i], first[i], matches[i][1]) for i in range(len(matches)) if not continued[i]]


def _overlaps(taken: list[tuple[int, int]], first: int, end: int) -> bool:
    """Whether a word from ``first`` to before ``end`` lies in one of the disjoint, sorted ranges."""
    i = bisect_left(taken, (first, end))
    return bool((i > 0 and taken[i - 1][1] > first) or (i < len(taken) and taken[i][0] < end))


_SPANS = "array<struct<label:string,first:long,last:long,cover:double>>"
_TYPES = {"n_words": "long", "n_base": "long", "first_word": "long", "last_word": "long", "base_labels": "string",
          "labels": "string", "score": "double", "spans": _SPANS}


def _scan_batches(scanner: Scanner, text: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g in W.word_groups(batch.column(text), W.ALNUM):
                rows = [(f.n_words, len(f.starts), min(f.starts, default=None), max(f.starts, default=None),
                         ",".join(sorted(f.base)), ",".join(sorted(f.base | {s.label for s in f.spans})), f.score,
                         [vars(s) for s in f.spans]) for f in scanner.scan(g)]
                cols = zip(*rows, strict=True)
                types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct(
                    [("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("cover", pa.float64())]))]
                made = [pa.array(c, t) for c, t in zip(cols, types, strict=True)]
                kept = [i for i in range(batch.num_columns) if i != text]
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(g.row, len(g)) for i in kept), *made],
                                                 names=[*(batch.schema.names[i] for i in kept), *_TYPES])
    return run


def scan(docs: DataFrame, scanner: Scanner | None = None, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` without ``text_col``, with the licence words of its whole text.

    Adds ``n_words``; ``n_base``, ``first_word`` and ``last_word`` (places of the
    scanner's phrases: their number, least and greatest first word, counted from
    0); ``base_labels`` (of those phrases) and ``labels`` (those and the labels of
    all covered templates), distinct, sorted and joined by commas; ``score``, 1
    with a phrase and else the greatest share of a template's words that one chain
    covers; and ``spans`` (label, first and last word, share covered).  Input
    columns of these names are replaced.

    A NULL or empty text has no words: 0, NULL, '' and score 0.  Rows that repeat
    are treated alike; an empty table gives an empty result.  Texts are streamed
    half a megabyte at a time; memory is that of one text's words and matches.
    """
    slim = docs.drop(*[c for c in _TYPES if c != text_col])
    types = [f"`{c}` {kind}" for c, kind in slim.dtypes if c != text_col] + [f"{c} {t}" for c, t in _TYPES.items()]
    return map_arrow(slim, _scan_batches(scanner or Scanner(), slim.columns.index(text_col)), ", ".join(types))
