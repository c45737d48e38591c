"""The trained operators by held-out accuracy, and the pipeline against its own stages in plain Python."""

import os
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import no_docs, odd_docs, odd_rows, prose, shingle_set, spaced  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from layerstar.llm import language_id, quality, registry
from layerstar.llm import words as W
from layerstar.llm.common import read_table
from layerstar.session import work_root

SF = "/root/testdata/sf0.01"
given = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not available")

LANGS = {"aa": "alpha gamma delta lambda sigma".split(), "bb": "eins zwei drei fünf größe".split(), "cc": "数据 处理 语言 模型 训练".split()}


def texts_of(lang, n):
    rng = np.random.default_rng(sum(map(ord, lang)))
    return [" ".join(rng.choice(LANGS[lang], 12)) for _ in range(n)]


# ------------------------------------------------------------------ languages
def brute_kernel_scores(train, langs, text):
    """The same regression with explicit kernels over all landmarks, in plain numpy."""
    seen = np.zeros(language_id.PLACES, dtype=bool)
    grams = [set(language_id.present_grams(np.frombuffer(t.encode(), np.uint8), seen).tolist()) for t in [*train, text]]
    k = lambda x, y: len(x & y) / np.sqrt(max(1, len(x)) * max(1, len(y)))
    known = sorted(set(langs))
    marks = [i for lang in known for i in [j for j, x in enumerate(langs) if x == lang][:language_id.LANDMARKS]]
    gram = np.array([[k(x, grams[m]) for m in marks] for x in grams])
    values, vectors = np.linalg.eigh(gram[marks])
    held = values > 1e-8 * values[-1]
    x = np.hstack([gram[:-1] @ (vectors[:, held] / np.sqrt(values[held])), np.ones((len(train), 1))])
    share = np.array([1 / langs.count(a) for a in langs])
    y = np.array([[1.0 if a == b else -1.0 for b in known] for a in langs])
    penalty = np.diag([language_id.RIDGE] * (x.shape[1] - 1) + [1e-9])
    beta = np.linalg.solve(x.T @ (x * share[:, None]) + penalty, x.T @ (y * share[:, None]))
    return np.append(gram[-1] @ (vectors[:, held] / np.sqrt(values[held])), 1.0) @ beta


def test_collapsed_weights_equal_the_kernel_expansion():
    train = [t for lang in LANGS for t in texts_of(lang, 5)]
    langs = [lang for lang in LANGS for _ in range(5)]
    seen = np.zeros(language_id.PLACES, dtype=bool)
    places = [language_id.present_grams(np.frombuffer(t.encode(), np.uint8), seen) for t in train]
    model = language_id.train(langs, places)
    for text in ("alpha drei", "größe 处理", "x"):
        got = model.scores([language_id.present_grams(np.frombuffer(text.encode(), np.uint8), seen)])[0]
        assert np.allclose(got, brute_kernel_scores(train, langs, text), atol=1e-3)


def test_languages_of_odd_texts(spark, odd_docs, odd_rows):
    rows = [(i, t, lang) for lang in LANGS for i, t in enumerate(texts_of(lang, 40))]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == sorted(LANGS)
    got = language_id.predict(odd_docs, model).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in odd_rows)
    by_id = {r.doc_id: r for r in got}
    for i in (60, 61, 62, 65):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 and r.lang_pred in (*LANGS, "und") for r in got)
    assert by_id[66].lang_pred != "und" and by_id[67].lang_pred != "und"
    assert {r.lang_pred for r in language_id.predict(odd_docs, None).collect()} == {"und"}
    assert language_id.fit(odd_docs.filter("doc_id < -1")) is None


def test_one_id_on_many_rows_is_one_text_of_the_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language_id, "train", lambda langs, places: seen.append(langs))
    monkeypatch.setattr(quality, "train", lambda features, labels: seen.append(labels))
    texts = F.concat(F.lit("text number "), F.col("id").cast("string"))
    docs = spark.range(20_000).select(F.when(F.col("id") < 19_000, 7).otherwise(F.col("id")).alias("doc_id"),
                                      texts.alias("text"), F.lit("aa").alias("lang"))
    language_id.fit(docs)
    assert 0 < len(seen[0]) <= language_id.SAMPLE
    quality.fit(docs, docs.select("doc_id", F.lit(1).alias("quality")).distinct())
    assert len(seen[1]) == 1001
    quality.fit(docs, docs.select("doc_id", F.lit(1).alias("quality")))
    assert len(seen[2]) <= quality.SAMPLE


def test_many_languages_share_the_sample(spark):
    docs = spark.range(24_000).select(
        F.col("id").alias("doc_id"), (F.col("id") % 200).cast("string").alias("lang"),
        F.expr("translate(array_join(transform(sequence(1, 30), i -> concat(id % 200, 'x', abs(xxhash64(id, i)) % 9)), ' '), "
               "'0123456789', 'abcdefghij')").alias("text"))
    model = language_id.fit(docs)
    assert len(model.langs) == 200
    got = language_id.predict(docs.filter("doc_id < 400"), model, keep=("doc_id", "lang")).collect()
    assert sum(r.lang == r.lang_pred for r in got) > 360


# -------------------------------------------------------------------- quality
def test_gradients_by_finite_differences():
    rng = np.random.default_rng(1)
    x, first, y = rng.normal(size=(9, len(quality.FEATURES))), np.array([0, 1, 4, 9]), np.array([1.0, 0.0, 1.0])
    shapes = {"encode": (len(quality.FEATURES), 4), "encode_0": (4,), "look": (4, 3), "gate": (4, 3), "weigh": (3,),
              "read": (4,), "read_0": (1,)}
    model = quality.Model(np.zeros(x.shape[1]), np.ones(x.shape[1]), {k: rng.normal(size=s) * 0.5 for k, s in shapes.items()})

    def loss():
        p = model.forward(x, first)["score"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()
    for name, gradient in quality._gradients(model, x, first, y).items():
        flat = model.params[name].reshape(-1)
        for i in range(0, len(flat), max(1, len(flat) // 5)):
            kept = flat[i]
            flat[i] = kept + 1e-6
            up = loss()
            flat[i] = kept - 1e-6
            down = loss()
            flat[i] = kept
            assert abs((up - down) / 2e-6 - gradient.reshape(-1)[i]) < 1e-6, name


def test_attention_sums_to_one_and_reads_whole_texts():
    (g,) = W.word_groups(pa.array([prose(1, 500), "", None, "a"]), W.SPACED)
    x, first = quality.passage_features(g)
    assert np.diff(first).tolist() == [8, 1, 1, 1] and x[first[1], -1] == x[first[2], -1] == 1.0
    model = quality.train([x[first[i]:first[i + 1]] for i in (0, 1, 3, 0)], [1, 0, 1, 1])
    f = model.forward(model.standardised(x), first)
    assert np.allclose(np.add.reduceat(f["a"], first[:-1]), 1.0)
    assert quality.train([], []) is None


def test_quality_of_odd_texts(spark, odd_docs, odd_rows):
    labels = spark.createDataFrame([(10, 1), (11, 1), (66, 0), (67, 0), (12, None), (None, 1), (999, 0)], "doc_id long, quality int")
    model = quality.fit(odd_docs, labels)
    got = quality.with_score(odd_docs, model)
    assert got.columns == [c for c in odd_docs.columns if c != "score"] + ["score"]
    rows = got.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(odd_rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in quality.with_score(odd_docs, None).collect()} == {0.5}


@given
def test_held_out_accuracy(spark):
    langs = {r.doc_id: r.lang for r in read_table(spark, SF, "documents").collect()}
    rows = [r for r in registry.op9_language_id(spark, SF).collect() if r.held_out]
    assert len(rows) > 250 and sum(r.lang_pred == langs[r.doc_id] for r in rows) >= 0.97 * len(rows)
    marks = {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
    rows = [r for r in registry.op10_quality(spark, SF).collect() if r.held_out and r.doc_id in marks]
    assert len(rows) > 80 and sum(r.predicted == marks[r.doc_id] for r in rows) >= 0.95 * len(rows)


# ------------------------------------------------------------------- pipeline
@given
def test_stages_on_odd_rows(spark, odd_docs, odd_rows, no_docs):
    """Every stage takes odd and empty tables, keeps the columns, and does its work."""
    docs, before = odd_docs, Counter(i for i, _ in odd_rows)
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, SF)
        assert out.columns == odd_docs.columns, name
        path = f"{spark.conf.get('spark.checkpoint.dir')}/odd-{name.replace(' ', '-')}"
        out.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        after = Counter(r.doc_id for r in docs.select("doc_id").collect())
        assert not after - before, name
        if name == "MinHash near-dedup":
            kept = [(r.doc_id, shingle_set(r.text)) for r in docs.collect()]
            for k, (_, x) in enumerate(kept):
                assert not any(x and y and 100 * len(x & y) >= 75 * len(x | y) for _, y in kept[:k])
        if name == "substring dedup":
            assert after == before
        before = after
        assert step(spark, no_docs, SF).count() == 0, name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert Counter((r.doc_id, r.text, r.source) for r in packed) == Counter((r.doc_id, r.text, r.source) for r in docs.collect())
    assert all(r.n_tokens == len(spaced(r.text)) <= r.bucket_len for r in packed)
    assert len({(r.batch, r.slot) for r in packed}) == len(packed)
    # repeated rows and NULL ids as well: every row has one slot, with its own text
    packed = corpus_pipeline.STAGES[-1][1](spark, odd_docs, SF).collect()
    assert Counter((r.doc_id, r.text, r.score) for r in packed) == Counter((i, t, "clash") for i, t in odd_rows)
    assert all(r.n_tokens == len(spaced(r.text)) for r in packed) and len({(r.batch, r.slot) for r in packed}) == len(odd_rows)
    assert corpus_pipeline.STAGES[-1][1](spark, no_docs, SF).count() == 0


@given
def test_run_applies_the_stages_in_order(spark):
    docs = read_table(spark, SF, "documents")
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF)
    root = work_root(spark).removeprefix("file://")
    there = set(os.listdir(root)), set(os.listdir(f"{root}/llm"))
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "text", "lang", "source", "n_chars", "bucket", "batch", "slot"} <= set(got.columns)
    assert Counter(map(tuple, docs.collect())) == Counter(map(tuple, got.collect()))
    # only the last table is left on disk
    (made,) = set(os.listdir(root)) - there[0]
    assert os.listdir(f"{root}/{made}") == ["4"] and set(os.listdir(f"{root}/llm")) == there[1]


@given
def test_a_clean_document_stays_as_it_is(spark):
    rows = [(10_000 + i, prose(7000 + i, 40 + 20 * i)) for i in range(12)]
    clean = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = read_table(spark, SF, "documents").unionByName(clean)
    for name, step in corpus_pipeline.STAGES[1:4]:
        docs = step(spark, docs, SF)
    got = {r.doc_id: (r.text, r.n_chars) for r in docs.filter("doc_id >= 10000").collect()}
    assert got == {i: (t, len(t)) for i, t in rows}
