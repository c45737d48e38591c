"""Small tables with every odd case, shared by the tests of the operators."""

import random
import re

import pytest
from pyspark.sql import functions as F

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaced(text):
    """Words between ASCII white space, A-Z lower-cased."""
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def shingle_set(text, k=5):
    w = spaced(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def prose(seed, n, vocabulary=4000):
    """n invented words in sentences, the same for the same seed."""

    r = random.Random(seed)
    out, left = [], 0
    for _ in range(n):
        w = f"w{r.randrange(vocabulary):x}"
        if left == 0:
            left = r.randrange(4, 14)
            w = w.capitalize()
        left -= 1
        out.append(w + ("." if left == 0 else ""))
    return " ".join(out)


def components(ids, links):
    """Least id reachable, by id."""
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text): copies, near copies, shared passages, odd and missing texts, ids that repeat or are missing."""
    base = prose(1, 200)
    words = base.split()
    near = [" ".join(words[:i * 7] + ["changed"] + words[i * 7 + 1:]) for i in range(1, 12)]
    chain = [" ".join(words[k * 12:] + prose(900 + k, k * 12).split()) for k in range(1, 6)]
    passage = prose(77, 70)
    rows = [(1, base), (2, base), (3, base.upper()), (4, base.replace(" ", "\n\t "))]
    rows += [(10 + i, t) for i, t in enumerate(near)]
    rows += [(30 + i, t) for i, t in enumerate(chain)]
    rows += [(40 + i, f"{prose(300 + i, 60 + i)} and then {passage} {prose(400 + i, 50)}") for i in range(4)]
    rows += [(50 + i, prose(500 + i, 3 + 40 * i)) for i in range(8)]
    rows += [(60, None), (61, ""), (62, " \n\t "), (63, "one two three"), (64, "One  two three"), (65, "!!! ??? ..."),
             (66, "a " * 3000), (67, "x" * 20000), (68, "naïve café “quoted” 数据 处理 ünïcode " * 20),
             (69, prose(5, 6000)), (70, prose(6, 30)), (70, prose(7, 30)), (71, base), (71, base),
             (None, prose(8, 40)), (None, prose(8, 40)), (None, base), (72, prose(8, 40))]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows, tmp_path_factory):
    """The rows as a table, with extra columns whose names the operators use themselves."""
    path = str(tmp_path_factory.mktemp("odd") / "docs")
    rows = [(i, t, None if n % 5 == 0 else "en", f"s{n % 3}", None if t is None else len(t)) for n, (i, t) in enumerate(odd_rows)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("id", "node", "comp", "check", "score", "shard", "slot", "size", "bucket", "label", "n_removed", "_row", "k", "a"):
        df = df.withColumn(c, F.lit("clash"))
    df.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark, odd_docs):
    return odd_docs.filter("doc_id < -1")
