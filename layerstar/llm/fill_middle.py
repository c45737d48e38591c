"""Fill-in-middle transformation of texts by piece tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerstar.llm.common import map_arrow

#: Sentinels before the prefix, the suffix and the middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Share of the texts that stay plain from (in percent), and share of the others in suffix-first order.
PLAIN_FROM, SPM_BELOW = 90, 20
#: The order in which an arrangement writes the parts (0 prefix, 1 suffix, 2 middle); their sentinels go with them.
ARRANGEMENTS = {"psm": (0, 1, 2), "spm": (1, 0, 2)}
#: The order of the parts in the text itself.
_READING = (0, 2, 1)
_TEXT, _MARK = 0, 1         # the two buffers


@dataclass(frozen=True)
class Piece:
    """A descriptor: ``size`` bytes of a buffer from ``start`` on."""

    buffer: int
    start: int
    size: int


class PieceTable:
    """A text as descriptors over buffers that never change.

    Buffer 0 is the text in UTF-8, buffer 1 holds the sentinels one after the
    other.  Edits replace descriptors; no byte is moved or copied.
    """

    def __init__(self, text: bytes, marks: bytes, pieces: list[Piece] | None = None) -> None:
        self.text, self.marks = text, marks
        self.buffers = (memoryview(text), memoryview(marks))
        self.pieces = [Piece(_TEXT, 0, len(text))] if pieces is None else pieces

    def with_pieces(self, pieces: list[Piece]) -> PieceTable:
        return PieceTable(self.text, self.marks, pieces)

    def cut(self, at: int) -> PieceTable:
        """The first descriptor that holds byte position ``at`` of the document is split there, an end into an empty one."""
        out, passed = [], 0
        for p in self.pieces:
            if passed <= at <= passed + p.size:
                out += [Piece(p.buffer, p.start, at - passed), Piece(p.buffer, p.start + at - passed, p.size - at + passed)]
                at = -1                         # once only
            else:
                out.append(p)
            passed += p.size
        return self.with_pieces(out)

    def stream(self) -> Iterator[memoryview]:
        for p in self.pieces:
            yield self.buffers[p.buffer][p.start:p.start + p.size]

    def sha256(self) -> str:
        h = hashlib.sha256()
        for part in self.stream():
            h.update(part)
        return h.hexdigest()

    def bytes(self) -> bytes:
        return b"".join(self.stream())


def code_points(text: bytes) -> int:
    data = np.frombuffer(text, dtype=np.uint8)
    return int(len(data) - np.count_nonzero((data & 0xC0) == 0x80))


def byte_offsets(text: bytes, points: list[int]) -> list[int]:
    """Byte offset of each position counted in code points."""
    data = np.frombuffer(text, dtype=np.uint8)
    starts = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    return [int(starts[p]) for p in points]


class Transform:
    """The rule: where a text is cut and how its parts are arranged."""

    def __init__(self, seed: str = "1", sentinels: tuple[str, str, str] = SENTINELS, plain_from: int = PLAIN_FROM,
                 spm_below: int = SPM_BELOW) -> None:
        self.seed, self.plain_from, self.spm_below = seed, plain_from, spm_below
        self.sentinels = [s.encode() for s in sentinels]
        self.marks = b"".join(self.sentinels)
        ends = np.cumsum([len(s) for s in self.sentinels])
        self.mark_pieces = [Piece(_MARK, int(e) - len(s), len(s)) for e, s in zip(ends, self.sentinels, strict=True)]

    def draws(self, key: int | str | None) -> list[int]:
        """Four numbers of 32 bits from the row's key; a missing key is the empty string."""
        h = hashlib.sha256(f"{self.seed}:{'' if key is None else key}".encode()).hexdigest()
        return [int(h[8 * i:8 * i + 8], 16) for i in range(4)]

    def apply(self, key: int | str | None, text: bytes) -> tuple[PieceTable, str, int, int | None, int | None]:
        """(output, form, code points, those of the prefix, those of the middle)."""
        table = PieceTable(text, self.marks)
        n = code_points(text)
        h = self.draws(key)
        if n == 0 or h[2] % 100 >= self.plain_from or any(s in text for s in self.sentinels):
            return table, "plain", n, None, None
        form = "spm" if h[3] % 100 < self.spm_below else "psm"
        low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        a, b = byte_offsets(text, [low, high])
        prefix, middle, suffix = table.cut(b).cut(a).pieces
        return table.with_pieces(self.arranged([prefix, suffix, middle], form)), form, n, low, high - low

    def arranged(self, parts: list[Piece], form: str) -> list[Piece]:
        """(prefix, suffix, middle) in the order of ``form``, each behind its sentinel."""
        return [p for i in ARRANGEMENTS[form] for p in (self.mark_pieces[i], parts[i])]

    def restore(self, output: bytes, form: str) -> PieceTable:
        """The original text, from the output's bytes and its form alone.

        The output is a piece table of one descriptor; it is cut round its
        sentinels, and the inverse permutation puts the parts in reading order.
        No text that holds a sentinel is ever arranged, so each is found once.
        """
        table = PieceTable(output, self.marks)
        if form == "plain":
            return table
        order = ARRANGEMENTS[form]
        starts, at = [], 0
        for i in order:
            at = output.index(self.sentinels[i], at)
            starts.append(at)
            at += len(self.sentinels[i])
        for at, i in zip(reversed(starts), reversed(order), strict=True):
            table = table.cut(at + len(self.sentinels[i])).cut(at)
        # an empty piece, then sentinel and part in turns
        written = table.pieces[2::2]
        inverse = {part: place for place, part in enumerate(order)}
        return table.with_pieces([written[inverse[part]] for part in _READING])


def _texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text, one at a time; NULL is empty."""
    column = column.cast(pa.large_binary())
    for value in column:
        yield value.as_py() or b""


def _transform_batches(rule: Transform, key: int, text: int, output: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, raw in zip(batch.column(key).to_pylist(), _texts(batch.column(text)), strict=True):
                table, form, n, prefix, middle = rule.apply(k, raw)
                whole = table.bytes()
                rows.append((n, form, prefix, middle, table.sha256(), rule.restore(whole, form).sha256(),
                             whole if output else None))
            n, form, prefix, middle, out, back, whole = zip(*rows, strict=True) if rows else ((),) * 7
            made = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()), pa.array(out, pa.string()), pa.array(back, pa.string())]
            if output:
                made.append(pa.array(whole, pa.binary()).cast(pa.string()))
            kept = [c for i, c in enumerate(batch.columns) if i != text]
            names = [c for i, c in enumerate(batch.schema.names) if i != text]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=[*names, *_COLUMNS, *([_OUTPUT] if output else [])])
    return run


_COLUMNS = ("n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
_OUTPUT = "output"


def transform(docs: DataFrame, rule: Transform | None = None, key_col: str = "doc_id", text_col: str = "text",
              with_output: bool = True) -> DataFrame:
    """Every row of ``docs`` with its text arranged for fill-in-middle training.

    Adds ``n`` (code points), ``form`` (plain, psm or spm), ``prefix_chars`` and
    ``middle_chars`` (NULL if plain), ``output_sha256``, ``restored_sha256`` (of
    the text that ``restore`` rebuilds from the output's bytes and the form) and,
    unless ``with_output`` is off, ``output``, which takes the place of
    ``text_col``.  Input columns of these names are replaced, all others but
    ``text_col`` stay.

    NULL and empty texts are plain with an empty output; a NULL key counts as the
    empty string; rows that repeat are treated alike; an empty table gives an
    empty result.  A text is one buffer and at most six descriptors, so memory is
    that of one text at a time beside the batch.
    """
    slim = docs.drop(*[c for c in (*_COLUMNS, _OUTPUT) if c not in (key_col, text_col)])
    types = [f"`{c}` {kind}" for c, kind in slim.dtypes if c != text_col]
    types += ["n long", "form string", "prefix_chars long", "middle_chars long", "output_sha256 string", "restored_sha256 string"]
    types += [f"{_OUTPUT} string"] if with_output else []
    work = _transform_batches(rule or Transform(), slim.columns.index(key_col), slim.columns.index(text_col), with_output)
    return map_arrow(slim, work, ", ".join(types))


def _restore_batches(rule: Transform, output: int, form: int, text_col: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = batch.column(form).to_pylist()
            texts = [rule.restore(raw, f or "plain").bytes() for raw, f in zip(_texts(batch.column(output)), forms, strict=True)]
            kept = [i for i in range(batch.num_columns) if i not in (output, form)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), pa.array(texts, pa.binary()).cast(pa.string())],
                                             names=[*(batch.schema.names[i] for i in kept), text_col])
    return run


def restore(rows: DataFrame, rule: Transform | None = None, output_col: str = "output", form_col: str = "form",
            text_col: str = "text") -> DataFrame:
    """The texts of a transformed table, in ``text_col`` in place of output and form."""
    slim = rows.drop(*[c for c in (text_col,) if c not in (output_col, form_col)])
    types = [f"`{c}` {kind}" for c, kind in slim.dtypes if c not in (output_col, form_col)]
    work = _restore_batches(rule or Transform(), slim.columns.index(output_col), slim.columns.index(form_col), text_col)
    return map_arrow(slim, work, ", ".join([*types, f"`{text_col}` string"]))


def digests(docs: DataFrame, rule: Transform | None = None, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``transform`` without the output texts: the key and the columns that describe the output."""
    slim = docs.select(F.col(key_col), F.col(text_col))
    return transform(slim, rule, key_col, text_col, with_output=False)
