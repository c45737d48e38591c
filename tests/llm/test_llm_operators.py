"""Every operator against brute force or plain rules, on small tables with every odd case."""

import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from llm_cases import alnum, components, no_docs, odd_docs, odd_rows, prose, shingle_set, spaced  # noqa: F401
from pyspark.sql import functions as F

from layerstar.llm import decontaminate, near_dup, packing, sharding, substring_dedup
from layerstar.llm import words as W


# ------------------------------------------------------------------ sharding
@pytest.mark.parametrize("n_shards", [1, 5, 24])
def test_shards_are_contiguous_and_balanced(odd_docs, odd_rows, n_shards):
    got = sharding.shard_by_bytes(odd_docs, n_shards).collect()
    sizes = [len((t or "").encode()) + 8 for _, t in odd_rows]
    expect = Counter((i, len((t or "").encode()) + 8, None if t is None else zlib.crc32(t.encode())) for i, t in odd_rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == expect
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r.shard].append(r)
    last = None
    for shard in sorted(by_shard):
        rows = sorted(by_shard[shard], key=lambda r: r.slot)
        assert [r.slot for r in rows] == list(range(len(rows)))
        order = [(-1 if r.doc_id is None else r.doc_id) for r in rows]
        assert order == sorted(order) and (last is None or last <= order[0])
        last = order[-1]
        assert abs(sum(r["size"] for r in rows) - sum(sizes) / n_shards) <= max(sizes)
    assert set(by_shard) <= set(range(n_shards))


def test_sharding_cuts_one_repeated_row(spark):
    df = spark.range(1000).select(F.lit(1).alias("doc_id"), F.lit("same text").alias("text"))
    per = Counter(r.shard for r in sharding.shard_by_bytes(df, 10).collect())
    assert sorted(per.values()) == [100] * 10


# ------------------------------------------------------------------- packing
def brute_boundaries(lengths, k):
    """Least padding over all ways to choose the boundaries."""
    from itertools import combinations
    values = sorted(set(lengths))
    best = None
    for n in range(min(k, len(values))):
        for cut in combinations(values[:-1], n):
            bounds = [*cut, values[-1]]
            pad = sum(next(b for b in bounds if b >= x) - x for x in lengths)
            best = pad if best is None else min(best, pad)
    return best


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_boundaries_are_optimal(k):
    lengths = [0, 0, 3, 3, 3, 4, 9, 10, 10, 11, 30, 31, 90, 90, 200]
    count = Counter(lengths)
    values = sorted(count)
    bounds = packing.optimal_boundaries(values, [count[v] for v in values], k)
    assert len(bounds) <= k and bounds[-1] == 200
    assert sum(next(b for b in bounds if b >= x) - x for x in lengths) == brute_boundaries(lengths, k)
    assert packing.optimal_boundaries([], [], 3) == []


def test_packing(odd_docs, odd_rows):
    got = packing.pack(odd_docs, n_buckets=4, token_budget=500).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((i, len(spaced(t))) for i, t in odd_rows)
    assert len({r.bucket for r in got}) == 4
    batches = defaultdict(list)
    for r in got:
        assert r.n_tokens <= r.bucket_len
        batches[r.batch].append(r)
    assert sorted(batches) == list(range(len(batches)))
    for rows in batches.values():
        assert len({r.bucket for r in rows}) == 1
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
        assert len(rows) == 1 or len(rows) * rows[0].bucket_len <= 500
    for bucket in range(4):               # all batches of a bucket but the last are full
        sizes = [len(rows) for b, rows in sorted(batches.items()) if rows[0].bucket == bucket]
        assert len(set(sizes[:-1])) <= 1 and (len(sizes) == 1 or sizes[-1] <= sizes[0])


def test_length_cells_are_few_and_ordered(spark):
    n = spark.range(0, 3_000_000, 7).select("id", packing.length_cell(F.col("id")).alias("cell"))
    row = n.agg(F.countDistinct("cell").alias("n"), F.max(F.when(F.col("id") <= packing.EXACT, F.abs(F.col("cell") - F.col("id")))).alias("exact"),
                F.max((F.col("cell") - F.col("id")) / F.greatest("id", F.lit(1))).alias("off"),
                F.min(F.col("cell") - F.col("id")).alias("least")).first()
    assert row.n < packing.EXACT + 13 * packing.PER_OCTAVE and row.exact == 0 and row.least >= 0
    assert row.off <= 1 / packing.PER_OCTAVE


# ------------------------------------------------------------ near-duplicates
def brute_groups(rows):
    sets = [shingle_set(t) for _, t in rows]
    links = []
    for x in range(len(rows)):
        for y in range(x):
            common = len(sets[x] & sets[y])
            if sets[x] and sets[y] and 100 * common >= 75 * (len(sets[x]) + len(sets[y]) - common):
                links.append((x, y))
    comp = components(range(len(rows)), links)
    groups = defaultdict(list)
    for i, c in comp.items():
        groups[c].append(rows[i][0])
    out = []
    for i, (doc, _) in enumerate(rows):
        known = [d for d in groups[comp[i]] if d is not None]
        least = min(known) if known else None
        out.append((doc, len(sets[i]), least, doc == least))
    return Counter(out)


@pytest.mark.parametrize("hub_rounds", [0, 3])
def test_near_duplicates_are_exact(odd_docs, odd_rows, hub_rounds, monkeypatch):
    monkeypatch.setattr(near_dup, "HUB_ROUNDS", hub_rounds)
    monkeypatch.setattr(near_dup, "TILE", 4)
    got = near_dup.near_duplicates(odd_docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute_groups(odd_rows)


def test_near_copies_that_link_only_in_a_chain(spark):
    """A large group whose members are mostly linked through others, and outsiders below the threshold."""
    words = prose(50, 120).split()
    rows = []
    for i in range(60):
        edited = list(words)
        for j in range(1 + i % 6):
            edited[(i * 17 + j * 23) % 120] = f"edit{i}x{j}"
        rows.append((i, " ".join(edited)))
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute_groups(rows)
    assert len({r.component_id for r in got}) < 60


def test_odd_sketch_estimates_similarity():
    import math

    import numpy as np
    rng = np.random.default_rng(0)
    both = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = np.unique(both[:2600]), np.unique(both[400:])
    sketch = near_dup._signatures([a, b])[3].view(np.uint64)
    odd = sum(bin(int(x)).count("1") for x in sketch[0] ^ sketch[1])
    bits, k = 64 * near_dup.SKETCH_LONGS, near_dup.BANDS * near_dup.ROWS
    estimate = 1 + bits / (4 * k) * math.log(1 - 2 * odd / bits)
    assert abs(estimate - 2200 / 3000) < 0.13


# ------------------------------------------------------------ repeated spans
def test_repeated_passages_go_but_the_first(odd_docs, odd_rows):
    got = substring_dedup.remove_repeats(odd_docs)
    assert set(odd_docs.columns) | {"n_sentences", "n_removed"} == set(got.columns)
    rows = got.collect()
    assert len(rows) == len(odd_rows) and all(r.node == "clash" for r in rows)
    passage = " ".join(prose(77, 70).split()[6:60])
    texts = defaultdict(list)
    for r in rows:
        texts[r.doc_id].append(r)
    assert [i for i in range(40, 44) if passage in texts[i][0].text] == [40]
    for i in range(41, 44):                              # what is not shared stays
        assert prose(300 + i - 40, 60 + i - 40).split()[20] in texts[i][0].text and texts[i][0].n_removed > 0
    assert texts[1][0].text == prose(1, 200) and texts[1][0].n_removed == 0
    assert texts[2][0].text == "" and texts[2][0].n_removed == texts[2][0].n_sentences
    assert texts[71][0].text == texts[71][1].text == ""
    clean = dict(odd_rows)
    for i in (50, 51, 52, 57, 60, 61, 62, 63, 65, 67, 69):
        assert texts[i][0].text == clean[i], i
    assert 0 < len(texts[68][0].text) < len(clean[68]) and 0 < len(texts[66][0].text) < len(clean[66])
    # rows that are equal in id and text are one document: both keep theirs
    assert [r.text for r in texts[None]].count(prose(8, 40)) in (0, 2)


def test_first_span_is_by_id_then_place(spark):
    p = prose(9, 60)
    rows = [(5, prose(10, 30) + " " + p), (2, p + " " + prose(11, 30)), (9, p + " " + prose(12, 30) + " " + p)]
    got = {r.doc_id: r.text for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    inner = " ".join(p.split()[8:50])
    assert inner in got[2] and inner not in got[5] and inner not in got[9]
    assert got[2] == rows[1][1]
    assert prose(12, 30).split()[10] in got[9]


HAN, THAI = "".join(map(chr, range(0x4E00, 0x4E00 + 600))), "".join(map(chr, range(0x0E01, 0x0E2F)))


def unspaced(seed, n, letters, stops=""):
    r = random.Random(seed)
    return "".join(r.choice(stops) if stops and r.random() < 0.04 else r.choice(letters) for _ in range(n))


@pytest.mark.parametrize("letters, stops", [(HAN, "。！？"), (HAN, ""), (HAN, " 、"), (THAI, ""), (THAI, " ")])
def test_repeats_in_scripts_without_spaces(spark, letters, stops):
    """Brute force over all runs of 150 characters: after, each is in one document only."""
    rows = []
    for k in range(25):
        passage = unspaced(1000 + k, 280, letters, stops)
        rows += [(3 * k + i, unspaced(7 * k + i, 100 + 13 * i, letters, stops) + passage + unspaced(9000 + 7 * k + i, 120, letters, stops))
                 for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs).collect()}
    seen = defaultdict(set)
    for i, text in got.items():
        for at in range(len(text) - 149):
            seen[text[at:at + 150]].add(i)
    assert len(got) == len(rows) and max(len(x) for x in seen.values()) == 1
    clean = dict(rows)
    for i, text in rows:                                 # the first stays; of the others, all that is their own
        own = 100 + 13 * (i % 3)
        if i % 3 == 0:
            assert got[i] == text
            continue
        others = [(clean[j][:100 + 13 * (j % 3)], clean[j][-120:]) for j in range(i - i % 3, i)]
        # a letter next to the passage that is the same by chance belongs to it
        left = max(len(os.path.commonprefix([text[:own][::-1], x[::-1]])) for x, _ in others)
        right = max(len(os.path.commonprefix([text[-120:], x])) for _, x in others)
        assert got[i].startswith(text[:own - left].rstrip()) and got[i].endswith(text[-120 + right:].strip())


@pytest.mark.parametrize("vocabulary, ends", [(30, 0), (50, 0), (3000, 0), (50, 0.05), (50, 0.12), (3000, 0.3), (3, 0)])
def test_every_repeated_run_of_49_words_holds_a_span(vocabulary, ends):
    """Runs of 49 words at different places of other texts share a span inside the run, always."""
    r = random.Random(vocabulary)

    def words(n):
        return [f"w{r.randrange(vocabulary)}" + ("." if r.random() < ends else "") for _ in range(n)]
    for _ in range(100):
        found = []
        runs = [words(49) for _ in range(30)]
        for _ in range(2):
            texts, starts = [], []
            for run in runs:
                before = words(r.randrange(40))
                starts.append(len(before))
                texts.append(" ".join(before + run + words(r.randrange(40))))
            (g,) = W.word_groups(pa.array(texts), W.SPACED)
            cut = substring_dedup.split_sentences(g)
            inside = [set() for _ in runs]
            for text, at, n, value in zip(*substring_dedup.spans(cut), strict=True):
                a, b = (cut.word[cut.first[text] + k] - g.first[text] - starts[text] for k in (at, at + n))
                if a >= 0 and b <= 49:
                    inside[text].add((a, b, value))
            found.append(inside)
        assert all(x & y for x, y in zip(*found, strict=True))


# ------------------------------------------------------------ decontamination
def brute_hits(rows, items):
    windows = defaultdict(set)
    for item, text in items:
        w = alnum(text)
        for i in range(len(w) - min(13, len(w)) + 1):
            if w:
                windows[tuple(w[i:i + min(13, len(w))])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in rows:
        w = alnum(text)
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if (key := tuple(w[i:i + size])) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[key]
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return Counter(out)


def test_contamination_is_exact(spark, odd_docs, odd_rows):
    base = prose(1, 200).split()
    items = [(1, " ".join(base[20:60])), (2, " ".join(base[50:80]).upper()), (10, "one two three"), (3, None), (4, ""),
             (5, "a a a a a a a a a a a a a a a"), (6, prose(999, 40)), (7, "three"), (None, " ".join(base[100:130])),
             (1, "naïve, café -- quoted"), (8, " ".join(base[20:60])), (11, "!!!")]
    table = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, window string")
    got = decontaminate.contamination(odd_docs, table).withColumn("dirty", decontaminate.contaminated()).collect()
    found = Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, hashlib.sha256(",".join(r["items"]).encode()).hexdigest(),
                     r.dirty) for r in got)
    assert found == brute_hits(odd_rows, items)


def test_no_benchmark_no_hits(spark, odd_docs, odd_rows):
    table = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.contamination(odd_docs, table).collect()
    assert len(got) == len(odd_rows) and all(r.n_hit == 0 and r["items"] == [] for r in got)


def test_a_full_bitmap_only_costs_time(spark, odd_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(decontaminate, "BITMAP_BITS", 64)
    items = [(1, " ".join(prose(1, 200).split()[20:60]))]
    got = decontaminate.contamination(odd_docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit) for r in got) == Counter(k[:3] for k in brute_hits(odd_rows, items).elements())


# --------------------------------------------------------------- empty tables
def test_empty_tables(spark, no_docs):
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    for df in (sharding.shard_by_bytes(no_docs, 3), packing.pack(no_docs), near_dup.near_duplicates(no_docs),
               substring_dedup.remove_repeats(no_docs), decontaminate.contamination(no_docs, items)):
        assert df.collect() == []
