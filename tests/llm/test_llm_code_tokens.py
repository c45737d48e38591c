"""Licence scan, fill-in-middle and tokenizer alignment against brute force."""

import hashlib
import os
import random
from collections import Counter

import pytest
from llm_cases import alnum, no_docs, odd_docs, odd_rows, prose  # noqa: F401
from pyspark.sql import functions as F

from layerstar.llm import fill_middle, license_scan, license_templates, token_links
from layerstar.llm import words as W

SCHEMA = "doc_id long, text string"


# -------------------------------------------------------------- licence scan
def brute_statistics(templates, sequence):
    """Length of the longest run ending at each word that stands in a template, by search."""
    runs = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    return [max((n for n in range(1, at + 1) if tuple(sequence[at - n:at]) in runs), default=0) for at in range(1, len(sequence) + 1)]


@pytest.mark.parametrize("seed", range(12))
def test_matching_statistics_and_places(seed):
    r = random.Random(seed)
    templates = [[r.randrange(4) for _ in range(r.randrange(0, 14))] for _ in range(4)]
    a = license_scan.Automaton()
    for i, t in enumerate(templates):
        a.add(i, t)
    doc = [r.randrange(5) for _ in range(80)]
    found = list(a.stream(doc))
    assert [n for _, n in found] == brute_statistics(templates, doc)
    for at, (v, n) in enumerate(found, 1):
        if n:
            run = doc[at - n:at]
            assert a.places(v) == sorted((i, j) for i, t in enumerate(templates) for j in range(n, len(t) + 1) if t[j - n:j] == run)


def brute_base(text):
    w = alnum(text)
    starts = [(i, label) for phrase, label in license_templates.PHRASES
              for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in starts]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in starts}))


LICENSED = [
    "All rights reserved. ALL RIGHTS, reserved all rights all rights reserved", "cc by by cc by-nc", "CC\nBY", "cc, by!",
    "GNU general public license version 3", "a general public licence", "général public license", "rights reserved all",
    "the general public license general public license, all rights reserved cc by", "cc by", "by", "ccby", "İ cc by",
]


def test_phrases_are_found_wherever_they_stand(spark):
    r = random.Random(3)
    pool = "cc by general public license all rights reserved the İ x9 naïve 数据".split()
    texts = LICENSED + [" ".join(r.choice(pool) for _ in range(r.randrange(0, 40))) for _ in range(300)] + [None, "", "\n", prose(1, 300)]
    texts.append(" ".join(r.choice(pool) for _ in range(150000)))             # longer than a group of texts
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(3)
    got = {x.doc_id: (x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels) for x in license_scan.scan(df).collect()}
    assert got == {i: brute_base(t) for i, t in enumerate(texts)}


def spans_of(text, **options):
    scanner = license_scan.Scanner(**options)
    return [scanner.scan(g)[0] for g in W.word_groups(license_scan.pa.array([text]), W.ALNUM)][0]


def test_templates_are_found_whole_changed_and_not_in_prose():
    for text, label in license_templates.TEMPLATES:
        n = len(alnum(text))
        f = spans_of(f"{prose(7, 90)} {text.upper()} {prose(8, 90)}")
        assert (label, 90, 90 + n - 1, 1.0) in [(s.label, s.first, s.last, s.cover) for s in f.spans]
    words = license_templates.TEMPLATES[0][0].split()
    changed = [w if i % 23 else "Foo Bar" for i, w in enumerate(words)]
    f = spans_of(prose(9, 50) + " " + " ".join(changed))
    assert [s.label for s in f.spans] == ["mit"] and license_scan.LEAST_COVER <= f.score < 1
    half = spans_of(" ".join(words[:len(words) // 2]))
    assert not half.spans and 0.4 < half.score < 0.6
    scattered = spans_of(" ".join(" ".join(words[i:i + 4]) + " " + prose(i, 20) for i in range(0, len(words), 4)))
    assert not scattered.spans                                                  # too far apart for a chain
    backwards = spans_of(" ".join(w for i in range(len(words) - 6, -1, -6) for w in words[i:i + 6]))
    assert "mit" not in [s.label for s in backwards.spans]
    clean = spans_of(prose(3, 3000))
    assert not clean.spans and clean.score == 0.0


def test_the_nearest_licence_wins():
    labels = lambda t: {s.label for s in spans_of(t).spans}
    assert labels("Licensed under the GNU General Public License.") == {"gpl"}
    assert labels("Licensed under the GNU General Public License, version 3") == {"gpl-3.0"}
    assert labels("It is licensed under CC BY.") == {"cc-by"}
    assert labels("Licensed under CC BY-NC 4.0") == {"cc-by-nc"}
    many = spans_of("Released under the MIT license. " * 5000)
    assert len(many.spans) == 5000 and {s.label for s in many.spans} == {"mit"}


def brute_chain(matches, gap):
    """Most words any chain covers, over all predecessors."""
    best = []
    for i, (a, b, t) in enumerate(matches):
        options = [b - a]
        for j in range(i):
            x, y, u = matches[j]
            gain = min(b - y, t - u, b - a)
            if x < a and gain > 0 and u - (y - x) < t - (b - a) and a - y <= gap and t - (b - a) - u <= gap:
                options.append(best[j] + gain)
        best.append(max(options))
    return max(best, default=0)


@pytest.mark.parametrize("seed", range(6))
def test_chains_equal_all_pairs(seed):
    r = random.Random(seed)
    template = [f"t{r.randrange(12)}" for _ in range(60)]
    scanner = license_scan.Scanner(templates=[(" ".join(template), "x")], phrases=[])
    doc = []
    while len(doc) < 400:
        at = r.randrange(0, 55)
        doc += template[at:at + r.randrange(2, 20)] + [f"o{r.randrange(9)}"] * r.randrange(0, 5)
    ids = [scanner.number.get(w.encode(), -1) for w in doc]
    found, before, length = [], 0, 0
    for at, (v, n) in enumerate(scanner.automaton.stream(ids), 1):
        if n <= length and length >= scanner.least_match:
            found += [(at - 1 - length, at - 1, stop) for _, stop in scanner.automaton.places(before)]
        before, length = v, n
    if length >= scanner.least_match:
        found += [(len(ids) - length, len(ids), stop) for _, stop in scanner.automaton.places(before)]
    f = spans_of(" ".join(doc), templates=[(" ".join(template), "x")], phrases=[])
    assert f.score == pytest.approx(brute_chain(sorted(found), scanner.most_gap) / 60)


def test_scan_of_odd_tables(spark, odd_docs, odd_rows, no_docs):
    got = license_scan.scan(odd_docs)
    assert "text" not in got.columns and {"id", "label", "slot"} <= set(got.columns)
    rows = got.select("doc_id", "n_words", "score", "labels").collect()
    assert Counter((x.doc_id, x.n_words) for x in rows) == Counter((i, len(alnum(t))) for i, t in odd_rows)
    assert license_scan.scan(no_docs).collect() == []


# ------------------------------------------------------------ fill in middle
def brute_fim(key, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


FIM_TEXTS = ["", None, "a", "ab", "日本語", "a<P>b", "<S>", "x<M", "<", "<P", "P><P", "é" * 7, "🙂🙂a", "́é", "<<S", "\r\n", "\x00"]


def test_fill_in_middle_equals_string_slicing(spark, odd_docs, odd_rows, no_docs):
    texts = [(i * 20 + k, t) for i, t in enumerate(FIM_TEXTS) for k in range(20)] + [(None, "no key"), (5, "again"), (5, "again")]
    df = spark.createDataFrame(texts, SCHEMA).withColumn("n", F.lit("clash")).withColumn("more", F.lit(1)).repartition(3)
    out = fill_middle.transform(df)
    assert out.columns[:2] == ["doc_id", "more"]
    got = Counter((x.doc_id, x.n, x.form, x.prefix_chars, x.middle_chars, x.output, x.output_sha256, x.restored_sha256)
                  for x in out.collect())
    expect = [(k, t, *brute_fim(k, t)) for k, t in texts]
    assert got == Counter((k, n, form, a, b, o, sha(o), sha(t or "")) for k, t, n, form, a, b, o in expect)
    assert {x[2] for x in got} == {"plain", "psm", "spm"}
    back = Counter((x.doc_id, x.text) for x in fill_middle.restore(out).collect())
    assert back == Counter((k, t or "") for k, t in texts)
    odd = Counter((x.doc_id, x.output_sha256, x.restored_sha256) for x in fill_middle.digests(odd_docs).collect())
    assert odd == Counter((k, sha(brute_fim(k, t)[-1]), sha(t or "")) for k, t in odd_rows)
    assert fill_middle.transform(no_docs).collect() == []


def test_piece_table_never_copies_or_loses_bytes():
    table = fill_middle.PieceTable(b"abcdef", b"")
    for at in (0, 6, 3, 3, 1):
        table = table.cut(at)
        assert table.bytes() == b"abcdef"
    assert len(table.pieces) == 6 and table.sha256() == sha("abcdef")
    assert all(p.buffer == 0 for p in table.pieces)


@pytest.mark.parametrize("sentinels", [("<P>", "<S>", "<M>"), ("<|pre|>", "<|suf|>", "<|mid|>"), ("<S>", "<P>", "<M>")])
def test_restore_needs_output_and_form_only(sentinels):
    rule = fill_middle.Transform(seed="7", sentinels=sentinels, plain_from=100, spm_below=50)
    for k in range(200):
        text = prose(k, k % 9).replace(" ", "é<") + "<" * (k % 3)
        table, form, *_ = rule.apply(k, text.encode())
        assert rule.restore(table.bytes(), form).bytes() == text.encode()


# --------------------------------------------------------- tokenizer alignment
given = pytest.mark.skipif(not os.path.isdir(token_links.FOLDER), reason="tokenizer files not available")


def pair():
    return token_links.load(token_links.FOLDER, token_links.FILE_A, token_links.FILE_B)


def brute_align(texts):
    """Whole texts at once, ends by running sums, links over all pairs of equal ends."""
    p, rows, counts = pair(), [], Counter()
    for text in texts:
        a = p.a._t.encode(' ' + text, add_special_tokens=False).ids if text else []
        b = p.b.encode([text])[0] if text else []
        whole = b" " + (text or "").encode()
        if not text or b"".join(p.a.bytes[i] for i in a) != whole or b"".join(p.b.bytes[i] for i in b) != whole:
            rows.append(None)
            continue
        ends = [[sum(len(t.bytes[i]) for i in ids[:k + 1]) for k in range(len(ids))] for t, ids in ((p.a, a), (p.b, b))]
        links = [(x, y) for x, e in zip(a, ends[0], strict=True) for y, f in zip(b, ends[1], strict=True) if e == f]
        groups, i, k = [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            j, m = ends[0].index(end) + 1, ends[1].index(end) + 1
            groups.append(",".join(map(str, a[i:j])) + "|" + ",".join(map(str, b[k:m])))
            i, k = j, m
        counts.update(links)
        rows.append((len(a), len(b), len(groups), links, sha(";".join(groups))))
    top = {}
    for (_, y), c in counts.items():
        top[y] = max(top.get(y, 0), c)
    return [(0, 0, 0, 0, 0, 0, "") if x is None else
            (*x[:3], len(x[3]), sum(counts[e] == top[e[1]] for e in x[3]), sum(counts[e] for e in x[3]), x[4]) for x in rows]


TOKEN_TEXTS = ["", None, "Hello, world!", "  two  spaces\t\n\n", "naïve café – “quotes” 数据 处理 🙂", "<|endoftext|> and </s> <s> <unk>",
               "▁ is not a space", "a\x00b", "x" * 500, "def f(x):\n    return x + 1\n", "1234567890 3.14", "é ﬁ ① Å",
               "don't can't we'll", "‍ 　", " lead", "trail ", "Ἀρχή ἦν ὁ λόγος", "<0x41><0x0A>"]


@given
def test_alignment_equals_brute_force(spark):
    texts = TOKEN_TEXTS + [prose(i, 30) for i in range(12)] + [prose(1, 30)] * 3
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA + ", n_best string").repartition(3)
    cols = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = {x.doc_id: tuple(x[c] for c in cols) for x in token_links.align(df).collect()}
    assert got == dict(enumerate(brute_align(texts)))
    assert got[6][0] == 0 and got[5][0] > 0


@given
def test_texts_in_pieces_equal_whole_ones(monkeypatch):
    p = pair()
    assert p.divisible
    r = random.Random(4)
    words = ["the", "data", "42", "naïve", "don't", "x,", "数据", "<s>", "  ", "\n", "it's", "-"]
    text = " ".join(r.choice(words) for _ in range(3000))
    parts = token_links.parts_of(text, True, 50)
    assert len(parts) > 50 and " ".join(parts) == text
    assert token_links.parts_of(text, False, 50) == [text]
    pieces = token_links._BETWEEN.split(text)
    assert len(pieces) > 1000 and " ".join(pieces) == text
    each_a = lambda cut: [i for part in cut for i in p.a.encode(part)]
    each_b = lambda cut: [i for part in p.b.encode(cut) for i in part]
    for cut in (parts, pieces):
        assert each_a(cut) == each_a([text]) and each_b(cut) == each_b([text])
    monkeypatch.setattr(token_links, "PART_CHARS", 500)
    texts = [text, None, "a b", "▁", "x" * 60 + " y", text + " ▁"]
    expect = [(*x[:4], x[6]) for x in brute_align(texts)]
    for size in (1, 4, 1 << 17):
        memory = token_links.Memory(p, size)
        assert [tuple(token_links.align_text(t, memory)[:5]) for t in texts] == expect
    latin = "".join(map(chr, range(1, 0x250)))
    for each in (each_a, each_b):                           # every character that may stand round a cut
        for c in latin:
            if token_links._BETWEEN.search(f"{c} {c}"):
                for other in ("a", "'", "é", ".", "9", "'s"):
                    assert each([f"{c} {other}"]) == each([c, other]) and each([f"{other} {c}"]) == each([other, c])


@given
def test_ranks_give_the_tokens_of_the_file():
    p, r = pair(), random.Random(11)
    assert p.a._ranked
    letters = [c for c in map(chr, range(1, 0x250)) if token_links._LATIN.fullmatch(c)]
    for _ in range(3000):
        text = "".join(r.choice(letters if r.random() < 0.4 else "etaoin shrdlu'.\n") for _ in range(r.randrange(1, 60)))
        assert p.a.encode(text) == p.a._t.encode(" " + text, add_special_tokens=False).ids


def test_tokens_without_bytes_stay_with_the_one_before():
    size = [1, 2, 0]
    assert token_links.slices([0, 2, 1], [1, 2, 0], size, size) == [(0, 3, 0, 3)]
    assert token_links.slices([1, 2, 1], [0, 0, 1], size, size) == [(0, 2, 0, 2), (2, 3, 2, 3)]
    assert token_links.links_of([1, 2], size, 0, 2) == [1, 2]


@given
def test_alignment_of_odd_tables(spark, odd_docs, odd_rows, no_docs):
    got = token_links.align(odd_docs)
    assert "text" not in got.columns and {"id", "label", "slot"} <= set(got.columns)
    rows = got.select("doc_id", "n_a", "n_links", "n_groups").collect()
    assert Counter((x.doc_id, x.n_a) for x in rows) == Counter((i, len(pair().a.encode(t)) if t else 0) for i, t in odd_rows)
    assert token_links.align(no_docs).collect() == []
