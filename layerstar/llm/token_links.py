"""Alignment of two tokenizers' outputs over the same texts."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerstar.llm.common import map_arrow, stage

#: Folder of the tokenizer files on every executor, and the files.
FOLDER = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: A text is worked on so many characters at a time.
PART_CHARS = 1 << 17
#: Alignments of twice so many different pieces are remembered by a Python worker; none of over so many characters.
REMEMBERED, LONGEST = 1 << 18, 40
#: So many pieces, wholly of such characters, are aligned in one go.
TOGETHER = 2000
#: A place at which both tokenizers begin a new token, whatever stands around it: a single space
#: between two ASCII or Latin characters that are no white space.
_BETWEEN = re.compile("(?<=[!-~À-ÖØ-öø-ɏ]) (?=[!-~À-ÖØ-öø-ɏ])")
_LATIN = re.compile("[\t\n\r -~À-ÖØ-öø-ɏ]*")
#: How byte-level BPE of this family splits texts before merging (fixed, public).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SAFE = re.compile("[!-~À-ÖØ-öø-ɏ](?:[\t\n\r -~À-ÖØ-öø-ɏ]*[!-~À-ÖØ-öø-ɏ])?")
_OVER_SPACE = re.compile(rb"(?:[!-~]|(?<!\xC2)[\x80-\xBF]) ")
_SPACE = "▁"
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def byte_alphabet() -> dict[str, int]:
    """The printable characters by which byte-level vocabularies write the 256 bytes.

    Fixed rule of the public format: printable Latin-1 characters stand for
    themselves, the other bytes in ascending order for U+0100 onwards.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def divisible(tokens: list[bytes]) -> bool:
    """Cutting texts at safe spaces is exact only if no token reaches over one."""
    return not any(_OVER_SPACE.search(t) for t in tokens)


class ByteLevel:
    """Byte-level BPE from a ``tokenizers`` file; encodes a leading space with the text."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks are the parallelism
        self._t = Tokenizer.from_file(path)
        self._t.encode_special_tokens = True
        special = {i for i, t in self._t.get_added_tokens_decoder().items()}
        table = byte_alphabet()
        self.bytes = [b""] * self._t.get_vocab_size()
        for token, i in self._t.get_vocab().items():
            self.bytes[i] = token.encode() if i in special else bytes(table[c] for c in token)
        self.divisible = divisible(self.bytes)
        self._ranked = self._by_ranks(path, special)

    def _by_ranks(self, path: str, special: set[int]):
        """The same tokenizer by ranks, several times as fast, if the file's merges are in the order of the ids
        that they make and there is nothing else to it; otherwise None.

        Used for ASCII and Latin text alone, on whose letters and digits all libraries agree.
        """
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = [spec["model"]["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        plain = [i for i in range(len(self.bytes)) if i not in special]
        split = spec["pre_tokenizer"]
        if (ids != plain[256:] or spec["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"]
                or not split.get("use_regex", True)):
            return None
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks={self.bytes[i]: i for i in plain}, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self._ranked and _LATIN.fullmatch(text):
            return self._ranked.encode_ordinary(" " + text)
        return self._t.encode(" " + text, add_special_tokens=False).ids


class Pieces:
    """A ``sentencepiece`` model, which adds the leading space itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        self._t = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self._t.get_piece_size()):
            piece = self._t.id_to_piece(i)
            byte = _BYTE.fullmatch(piece)
            self.bytes.append(bytes([int(byte[1], 16)]) if byte and self._t.is_byte(i) else piece.replace(_SPACE, " ").encode())
        self.divisible = divisible(self.bytes)

    def encode(self, pieces: list[str]) -> list[list[int]]:
        return self._t.encode(pieces, num_threads=1)


@dataclass
class Pair:
    """Both tokenizers with the byte lengths of their tokens."""

    a: ByteLevel
    b: Pieces

    def __post_init__(self) -> None:
        self.size_a, self.size_b = ([len(x) for x in t.bytes] for t in (self.a, self.b))
        self.divisible = self.a.divisible and self.b.divisible
        #: whether some token has no bytes, so that several may end in one place
        self.hollow = 0 in self.size_a or 0 in self.size_b


@lru_cache(maxsize=2)
def load(folder: str, file_a: str, file_b: str) -> Pair:
    """Once per Python worker."""
    return Pair(ByteLevel(f"{folder}/{file_a}"), Pieces(f"{folder}/{file_b}"))


def parts_of(text: str, divisible: bool, size: int = PART_CHARS) -> list[str]:
    """The text cut at some of the spaces where both tokenizers begin anew; the space itself goes,
    since both get or add one before every part."""
    out, at = [], 0
    while divisible and len(text) - at > size:
        place = _BETWEEN.search(text, at + size)
        if place is None:
            break
        out.append(text[at:place.start()])
        at = place.end()
    return [*out, text[at:]]


def slices(ids_a: list[int], ids_b: list[int], size_a: list[int], size_b: list[int]) -> list[tuple[int, int, int, int]]:
    """Groups (from, to in A, from, to in B) between the byte offsets at which tokens of both end.

    Each side has a dictionary from the end offset of a token to its index; the
    offsets that both dictionaries hold, in order, are where the lists are cut.
    Tokens without bytes end where the one before ends and stay with it.
    """
    ends_a = dict(zip(accumulate([size_a[i] for i in ids_a]), range(1, len(ids_a) + 1), strict=True))
    ends_b = dict(zip(accumulate([size_b[i] for i in ids_b]), range(1, len(ids_b) + 1), strict=True))
    out, i, k = [], 0, 0
    for end in sorted(ends_a.keys() & ends_b.keys()):
        j, m = ends_a[end], ends_b[end]
        out.append((i, j, k, m))
        i, k = j, m
    return out


def links_of(ids: list[int], size: list[int], start: int, stop: int) -> list[int]:
    """The tokens of a slice that end where it ends: the last one, and those before it if it has no bytes."""
    at = stop - 1
    while at > start and size[ids[at]] == 0:
        at -= 1
    return ids[at:stop]


#: Of one piece of a text: tokens of A, of B, groups, the groups as text, the links as numbers.
Alignment = tuple[int, int, int, str, tuple[int, ...]]


def align_pieces(pair: Pair, pieces: list[str]) -> list[Alignment | None]:
    """The alignment of each piece; None if the tokens of either side are not, byte by byte, a space and the piece.

    Several pieces must begin and end with safe characters: then they can be
    aligned as one text, a space between them, that is cut at their ends.
    """
    whole = (" " + " ".join(pieces)).encode()
    ids_a, ids_b = pair.a.encode(" ".join(pieces)), list(chain.from_iterable(pair.b.encode(pieces)))
    if b"".join([pair.a.bytes[i] for i in ids_a]) != whole or b"".join([pair.b.bytes[i] for i in ids_b]) != whole:
        return [None] if len(pieces) == 1 else [x for p in pieces for x in align_pieces(pair, [p])]
    many, size_a = len(pair.b.bytes), pair.size_a
    stops = iter(accumulate([len(p.encode()) + 1 for p in pieces]))
    out, names, links, from_a, from_b, end, stop = [], [], [], 0, 0, 0, next(stops)
    for i, j, k, m in slices(ids_a, ids_b, size_a, pair.size_b):
        a, b = ids_a[j - 1], ids_b[m - 1]
        if j - i == 1 == m - k:
            names.append(f"{a}|{b}")
            end += size_a[a]
        else:
            names.append(",".join([str(x) for x in ids_a[i:j]]) + "|" + ",".join([str(x) for x in ids_b[k:m]]))
            end += sum([size_a[x] for x in ids_a[i:j]])
        if pair.hollow:
            links += [x * many + y for x in links_of(ids_a, size_a, i, j) for y in links_of(ids_b, pair.size_b, k, m)]
        else:
            links.append(a * many + b)
        if end == stop:
            out.append((j - from_a, m - from_b, len(names), ";".join(names), tuple(links)))
            names, links, from_a, from_b, stop = [], [], j, m, next(stops, None)
    return out


class Memory:
    """Alignments of the pieces between safe spaces, mostly words: each is made once while it is remembered.

    Two generations of at most ``size`` pieces: the younger one takes what is made or used, and when it is
    full the elder one is forgotten.
    """

    def __init__(self, pair: Pair, size: int = REMEMBERED) -> None:
        self.pair, self.size = pair, size
        self.young: dict[str, Alignment | None] = {}
        self.elder: dict[str, Alignment | None] = {}
        self.long: list[str] = []           # given out last time, too long to be remembered

    def of(self, pieces: Iterable[str]) -> dict[str, Alignment | None]:
        """The alignment of every piece given, and perhaps of others."""
        for p in self.long:
            self.young.pop(p, None)
        self.long = []
        wanted = [p for p in set(pieces) if p not in self.young]
        if not wanted:
            return self.young
        if len(self.young) + len(wanted) > self.size:
            self.young, self.elder = {}, self.young
            wanted = list(set(pieces))
        found = {p: self.elder[p] for p in wanted if p in self.elder}
        new = [p for p in wanted if p not in found]
        safe = [p for p in new if _SAFE.fullmatch(p)] if self.pair.divisible else []
        for pieces in (safe[at:at + TOGETHER] for at in range(0, len(safe), TOGETHER)):
            found.update(zip(pieces, align_pieces(self.pair, pieces), strict=True))
        found.update((p, align_pieces(self.pair, [p])[0]) for p in new if p not in found)
        self.long = [p for p in new if len(p) > LONGEST]
        self.young.update(found)
        return self.young


def align_text(text: str | None, memory: Memory) -> tuple:
    """(tokens of A, of B, groups, links, hash of the groups, the distinct links, how often each)."""
    nothing = 0, 0, 0, 0, "", [], []
    if not text:
        return nothing
    sums, digest, between, linked = np.zeros(3, np.int64), hashlib.sha256(), "", []
    for part in parts_of(text, memory.pair.divisible):
        pieces = _BETWEEN.split(part) if memory.pair.divisible else [part]
        known = memory.of(pieces)
        found = [known[p] for p in pieces]
        if None in found:
            return nothing
        n_a, n_b, n_groups, names, links = zip(*found, strict=True)
        sums += (sum(n_a), sum(n_b), sum(n_groups))
        digest.update((between + ";".join(names)).encode())
        between = ";"
        linked.append(np.unique(np.fromiter(chain.from_iterable(links), np.int64), return_counts=True))
    link, times = linked[0]
    if len(linked) > 1:
        link, place = np.unique(np.concatenate([x for x, _ in linked]), return_inverse=True)
        times = np.zeros(len(link), np.int64)
        np.add.at(times, place, np.concatenate([n for _, n in linked]))
    return *sums.tolist(), int(times.sum()), digest.hexdigest(), link, times


_TYPES = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, _link array<long>, _times array<long>"


def _align_batches(folder: str, file_a: str, file_b: str, text: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(load(folder, file_a, file_b))
        for batch in batches:
            rows = [align_text(t.as_py(), memory) for t in batch.column(text)]
            cols = list(zip(*rows, strict=True)) if rows else [()] * 7
            kept = [i for i in range(batch.num_columns) if i != text]
            made = [*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string()),
                    *(pa.array(c, pa.list_(pa.int64())) for c in cols[5:])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), *made],
                names=[*(batch.schema.names[i] for i in kept), *(t.split()[0] for t in _TYPES.split(", "))])
    return run


def link_counts(aligned: DataFrame, vocabulary_b: int) -> DataFrame:
    """(_link, _count, _best): links over all texts by id pair, and whether no pair of its B id has more.

    Both tokens of a link end together in the same bytes, so one is a suffix of
    the other: there are at most as many pairs as the two vocabularies have bytes,
    whatever the number of texts.  Counts are summed before the shuffle.
    """
    each = aligned.select(F.explode(F.arrays_zip("_link", "_times")).alias("x"))
    counts = stage(each.groupBy(F.col("x._link").alias("_link")).agg(F.sum("x._times").alias("_count")), "link-counts")
    id_b = F.col("_link") % vocabulary_b
    most = counts.groupBy(id_b.alias("_b")).agg(F.max("_count").alias("_most"))
    return counts.join(most, id_b == F.col("_b")).select("_link", "_count", (F.col("_count") == F.col("_most")).alias("_best"))


def align(docs: DataFrame, text_col: str = "text", folder: str = FOLDER, file_a: str = FILE_A, file_b: str = FILE_B) -> DataFrame:
    """Every row of ``docs`` without ``text_col``, with the alignment of its two token lists.

    A encodes a space and the text, B adds that space itself; special tokens'
    strings are plain text.  Adds ``n_a``, ``n_b`` (tokens), ``n_groups`` (parts
    between common byte ends), ``n_links`` (A-B pairs that end together),
    ``n_best`` (links whose id pair is, over all texts, the most frequent of its B
    id, ties included), ``count_sum`` (of the id pairs' counts over the links) and
    ``groups_sha256``.  Input columns of these names are replaced.

    Texts that are NULL, empty, or that either tokenizer does not give back byte
    by byte have no tokens: zeros and ''.  Rows that repeat count each; an empty
    table gives an empty result.  Texts are cut at single spaces between ASCII or
    Latin characters, where both tokenizers always begin anew (checked against the
    vocabularies), and the alignment of a piece, mostly a word, is made once while
    it is remembered.  Memory is that of the remembered pieces, a bounded number,
    and of the text's distinct links.

    The alignment is stored once, with the distinct links of each text; the
    counts are joined to those.
    """
    made = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    slim = docs.drop(*[c for c in made if c != text_col])
    kept = [c for c in slim.columns if c != text_col]
    packed = slim.select(F.struct(*kept).alias("_row"), F.col(text_col).alias("_text"))
    rows = map_arrow(packed, _align_batches(folder, file_a, file_b, 1), f"_row {packed.schema['_row'].dataType.simpleString()}, {_TYPES}")
    aligned = stage(rows.withColumn("_at", F.monotonically_increasing_id()), "aligned")
    counts = link_counts(aligned, len(load(folder, file_a, file_b).b.bytes))
    each = aligned.select("_at", F.explode(F.arrays_zip("_link", "_times")).alias("x")).select("_at", "x._link", "x._times")
    # the counts are one row per possible pair at most; Spark broadcasts them if their size allows
    sums = (each.join(counts, "_link").groupBy("_at")
            .agg(F.sum(F.when(F.col("_best"), F.col("_times")).otherwise(0)).alias("n_best"),
                 F.sum(F.col("_times") * F.col("_count")).alias("count_sum")))
    out = aligned.drop("_link", "_times").join(sums, "_at", "left")
    zero = F.lit(0).cast("long")
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in kept], "n_a", "n_b", "n_groups", "n_links",
                      F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
