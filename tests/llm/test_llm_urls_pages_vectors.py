"""URL judgements, main texts and vector links."""

import math
from collections import Counter

import numpy as np
import pytest
from llm_cases import components, prose

from layerstar.llm import html_text, url_filter, vector_dup
from layerstar.llm.registry import URL_RULES

# ---------------------------------------------------------------------- URLs
CASES = [("http://x.example.com/en/1", "x.example.com", "/en/1", "example.com/en/"),
         ("https://WWW.Example.com/en/a?b=1#c", "www.example.com", "/en/a", "www.example.com/en/"),
         ("https://a.www.example.com/en/", "a.www.example.com", "/en/", "www.example.com/en/"),
         ("https://x.example.com/EN/1", "x.example.com", "/EN/1", "com/"),
         ("ftp://notexample.com/en/1", "notexample.com", "/en/1", "com/"),
         ("http://a.net/fr/1", "a.net", "/fr/1", "net/fr/"), ("http://net/es/", "net", "/es/", "net/es/"),
         ("http://a.net/de/1", "a.net", "/de/1", None), ("http://a.org?x=/en/", "a.org", "", None),
         ("http://a.com", "a.com", "", None), ("http://b.com#/en/", "b.com", "", None),
         ("a.com/en/", "", "", None), ("", "", "", None), (None, "", "", None), ("://", "", "", None),
         ("x://y://a.com/en/", "y:", "//a.com/en/", None), ("http://é.COM/\npath", "é.com", "/\npath", "com/")]


def test_urls_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "clash", "clash") for i, (u, *_) in enumerate(CASES)],
                                  "page_id long, url string, host string, verdict string")
    none = spark.createDataFrame([], "page_id long, bad int")
    got = {r.page_id: r for r in url_filter.judge_urls(pages, none, URL_RULES).collect()}
    verdict = dict(URL_RULES)
    for i, (url, host, path, rule) in enumerate(CASES):
        r = got[i]
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict.get(rule, "allow")), url
    assert url_filter.judge_urls(pages.filter("page_id < 0"), none, URL_RULES).collect() == []


def test_reputation_is_shrunk_and_bounded(spark):
    """Against the same arithmetic in plain Python."""
    counts = {"spam.a.org": (80, 76), "good.a.org": (200, 2), "new.a.org": (1, 1), "b.org": (50, 1), "c.de": (30, 3),
              "few.spam.de": (2, 2), "big.c.de": (400, 40)}
    rows, page = [], 0
    for host, (n, bad) in counts.items():
        for k in range(n):
            rows.append((page, f"http://{host}/{k}", int(k < bad)))
            page += 1
    rows += [(page, "http://unknown.org/1", None), (None, "http://b.org/", 1), (page + 1, None, 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, bad int")
    outcomes = df.select("page_id", "bad")
    got = {r.host: r for r in url_filter.judge_urls(df, outcomes, []).collect()}
    assert got["spam.a.org"].verdict == "block" and got["spam.a.org"].lower > 0.85
    for host in ("good.a.org", "b.org", "new.a.org", "unknown.org", "c.de", "big.c.de", ""):
        assert got[host].verdict == "allow", host
    counts[""] = (1, 0)
    levels = {"suffix": lambda h: h.split(".")[-1], "domain": lambda h: ".".join(h.split(".")[-2:]), "host": lambda h: h}
    total = [sum(x) for x in zip(*counts.values(), strict=True)]
    mean, above = {"": total[1] / total[0]}, lambda h: ""
    post = {}
    for name, level in levels.items():
        groups, prior = {}, {}
        for h, (n, b) in counts.items():
            g = groups.setdefault(level(h), [0, 0])
            g[0] += n
            g[1] += b
            prior[level(h)] = mean[above(h)]
        excess = sum(n * (b / n - prior[k]) ** 2 / (prior[k] * (1 - prior[k])) - 1 for k, (n, b) in groups.items())
        rho = excess / sum(n - 1 for n, _ in groups.values())
        w = 1 / min(max(rho, url_filter.LEAST_RHO), url_filter.MOST_RHO) - 1
        mean = {k: (b + w * prior[k]) / (n + w) for k, (n, b) in groups.items()}
        post = {k: (b + w * prior[k], n - b + w * (1 - prior[k])) for k, (n, b) in groups.items()}
        above = level
    for host, (a, b) in post.items():
        m = a / (a + b)
        assert math.isclose(got[host].lower, m - 1.645 * math.sqrt(m * (1 - m) / (a + b + 1)), abs_tol=1e-9), host
    # one bad page says little against a host: it is drawn to its domain
    assert got["few.spam.de"].lower < got["spam.a.org"].lower


def test_hosts_without_outcomes_are_judged_by_their_domain_and_suffix(spark):
    counts = {"a.bad.org": (400, 390), "b.bad.org": (300, 280), "a.good.org": (600, 6), "b.good.org": (500, 2),
              "x.one.spam": (300, 290), "y.two.spam": (300, 297), "once.fresh.org": (1, 1)}
    labelled = [(f"http://{host}/{k}", int(k < bad)) for host, (n, bad) in counts.items() for k in range(n)]
    fresh = {"new.bad.org": "block", "bad.org": "block", "deep.a.bad.org": "block", "new.good.org": "allow",
             "new.three.spam": "block", "new.unknown.org": "allow", "new.fresh.org": "allow", "a.nowhere": "allow"}
    rows = [(i, u, bad) for i, (u, bad) in enumerate(labelled + [(f"http://{h}/", None) for h in fresh])]
    df = spark.createDataFrame(rows, "page_id long, url string, bad int")
    got = url_filter.judge_urls(df, df.select("page_id", "bad"), [])
    assert got.count() == len(rows)
    got = {r.host: r for r in got.collect()}
    assert {h: got[h].verdict for h in fresh} == fresh
    # an unseen host's bound: its nearest known group's mean, with the variances of the levels down to it
    known = {(r.level, r.name): r for r in url_filter.host_reputation(
        df.select(url_filter.host_and_path("url")[0].alias("host"), "bad")).collect()}
    rho = {r.level: 1 / (r.weight + 1) for r in known.values() if r.weight is not None}
    for host, group, between in (("new.bad.org", ("domain", "bad.org"), ["host"]),
                                 ("new.three.spam", ("suffix", "spam"), ["domain", "host"]),
                                 ("a.nowhere", ("all", ""), ["suffix", "domain", "host"])):
        r = known[group]
        size = r.n if r.a is None else r.a + r.b
        variance = r["mean"] * (1 - r["mean"]) / (size + 1)
        for level in between:
            variance += (r["mean"] * (1 - r["mean"]) - variance) * rho[level]
        assert math.isclose(got[host].lower, r["mean"] - 1.645 * math.sqrt(variance), abs_tol=1e-9), host
    assert math.isclose(got["a.bad.org"].lower, known["host", "a.bad.org"].lower, abs_tol=1e-9)


# --------------------------------------------------------------------- pages
ARTICLE = [prose(i, 30 + 9 * i) for i in range(6)]


def page(article, before="", after=""):
    return (f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p><p>no</p>';</script></head>"
            f"<body><nav><ul><li><a href='/x'>Menu</a></ul></nav>{before}{article}{after}<footer>&copy; foot</footer></body></html>")


@pytest.mark.parametrize("html, text", [
    (page("<article><h1>H &amp; t</h1><p>" + "<p>".join(ARTICLE) + "</article>"), ["H & t", *ARTICLE]),
    (page("<article><p><b>One<br>two</b></p><p>th<i>r</i>ee &lt;p&gt; &#233;&nbsp;x</p><p></p></article>",
          "<div class='ad'>Buy now</div>", "<div class='cookie-notice'>We use cookies</div>"), ["One two", "three <p> é x"]),
    (page("<main><article><header><h1>T</h1><span>by me</span></header><p>Short.</p><form><p>Mail?</p></form><aside>x</aside>"
          "<p>End.</p></article><section id='comments'><article class='comment'><p>First!</p></article></section></main>"),
     ["T", "Short.", "End."]),
    (page("<div class='wrap has-sidebar'><article><p>a</p></article><div class='sidebar'>Links</div></div>"), ["a"]),
    (page("<div>" + "".join(f"<p>{p}</p>" for p in ARTICLE) + "</div>", "<div><a href=1>Home</a> <a href=2>About us</a></div>",
          "<div class='related'>More</div><div class='x'></div><div class='reader-comments'><p>" + prose(50, 60) + "</p></div>"), ARTICLE),
    (page("<main><h2>Only main</h2><p>text <a href=x>linked</a></p></main>"), ["Only main", "text linked"]),
    (page("<article><p>cut off <a href='x"), ["cut off <a href='x"]),
    (None, []), ("", []), ("<br>", []), ("<!-- never closed <p>x</p>", []), ("just text &amp; more", ["just text & more"]),
    ("<script>only", []), ("<p hidden>no</p><p style='display:none'>no</p><p>" + ARTICLE[3] + "</p>", [ARTICLE[3]]),
])
def test_main_text(html, text):
    assert html_text.main_text(html) == "\n".join(text)


def test_names_mark_as_a_whole():
    a, b, c, d, e, f = ARTICLE
    inner = (f"<h1 id='search'>T</h1><p class='ad-hoc'>{a}</p><section id='related-work'><h2 id='search-algorithms'>S</h2><p>{b}</p>"
             f"</section><section id='comments-on-the-method'><p>{c}</p></section><section id='advertising'><p>{d}</p></section>")
    text = "\n".join(["T", a, "S", b, c, d])
    away = "".join(f"<div class='{x}'><p>{e}</p></div>" for x in ("reader-comments", "ad-slot", "x relatedPosts", "social_links", "comment", "ad-1"))
    for whole in (f"<article>{inner}{away}</article>", f"<div class='post has-comments'><article>{inner}</article>{away}</div>",
                  f"<div id='page' class='cookies-not-set'><article>{inner}</article></div>",
                  f"<div class='cookies'><main>{inner}</main></div>", f"<div class='related'><article>{inner}</article></div>",
                  f"<article class='post has-comments'>{inner}</article><div class='related'><article>{f}</article></div>"):
        assert html_text.main_text(page(whole)) == text, whole
    assert html_text.main_text(page(f"<div class='newsletter'><p>{a}</p><p>{b}</p></div>")) == f"{a}\n{b}"
    assert html_text.main_text(page("<div class='related'><p hidden>no</p></div>")) == ""


@pytest.mark.parametrize("block", ["div class='entry-content'", "section itemprop='articleBody'", "div role='main'"])
def test_an_article_in_several_blocks_is_whole(block):
    a, b, c, d, *_ = ARTICLE
    tag = block.split()[0]
    blocks = [f"<{block}><p>{x}</p><p>Short.</p></{tag}>" for x in (a, c + " " + d, b)]
    tiny = f"<{block}><a href='/'>Home</a> 3 May</{tag}>"
    html = page(f"<div class='ad'>{d}</div>".join(blocks) + tiny,
                f"<h1><a href='/'>Site</a></h1><p>by me</p><h1>The title</h1><h2>and what it says</h2><div class='share'>x</div>")
    assert html_text.main_text(html) == "\n".join(["The title", "and what it says", a, "Short.", c + " " + d, "Short.", b, "Short."])


def test_a_paragraph_stays_however_dense_the_rest_is():
    long, last = [prose(60 + i, 400) for i in range(3)], prose(70, 50)[:250].strip()
    body = "".join(f"<p>{x}</p>" for x in long) + "<aside><p>1</p><p>2</p><p>3</p><p>4</p></aside>" + f"<p>{last}</p>"
    menu = "".join(f"<li><a href='/{i}'>One of the links of a long menu</a></li>" for i in range(9))
    assert html_text.main_text(page(f"<div>{body}</div>", f"<ul>{menu}</ul>")) == "\n".join([*long, last])


def test_long_and_broken_pages_end():
    for piece in ("<b>", "<a \"", "<!--", "</p>", "<p><div>", "<nav>", "&amp;", "< ", "<a b='c>"):
        html_text.main_text(piece * 50_000)
    for piece in ("<a \"'", "<a ''", "<a '' ", "\"'\"", "<form><header>", "<dialog open>", "<a b=\"<i>\" c='"):
        html_text.main_text(piece * 20_000)


def test_quoted_values_hold_markup():
    a, b = ARTICLE[:2]
    inner = f"""<p data-x='a>b' title="<i>1 > 0</i>">{a}</p><p class="x" data-json='{{"k": "</p>"}}'>{b} <b title=">">x</b></p>"""
    assert html_text.main_text(page(f"<article>{inner}</article>")) == f"{a}\n{b} x"
    assert html_text.main_text(page(f"<article><p data-id='menu' data-class='ad'>{a}</article>")) == a


@pytest.mark.parametrize("start, end", [("<form id='aspnetForm' action='./'>", "</form>"), ("<dialog open>", "</dialog>"),
                                        ("<header>", "</header>"), ("<form><div><header>", "</header></div></form>")])
def test_a_wrapper_round_the_article_is_no_reason_to_drop_it(start, end):
    a, b, c, d, *_ = ARTICLE
    inner = f"<h1>T</h1><p>{a}</p><form><label>Mail</label><input></form><p>{b}</p>"
    head = "<form class='search'><p>Find</p></form>"
    for block in (f"<article>{inner}</article>", f"<main>{inner}</main>", f"<div>{inner}</div>"):
        assert html_text.main_text(page(f"{start}{head}{block}{end}")) == "\n".join(["T", a, b]), block
    # elsewhere such an element is no part of the article, however much it says beside one
    assert html_text.main_text(page(f"<article><p>{a}</p></article>", f"{start}<p>{b[:40]}</p>{end}")) == a
    assert html_text.main_text(page(f"<article><p>{a}</p></article>", f"<aside><article>{b}</article></aside>")) == a
    assert html_text.main_text(page(f"<div><p>{a}</p></div>", f"<dialog><p>{a} {b} {c} {d}</p></dialog>")) == a


def test_teasers_and_comments_beside_the_article():
    a, b, c, d, e, f = ARTICLE
    body = f"<article><h1>T</h1><p>{a} {b} {c}</p><p>End.</p></article>"
    teaser = "<article><h3><a href='/2'>Another story to read</a></h3><p>It begins so.</p></article>"
    whole = "\n".join(["T", f"{a} {b} {c}", "End."])
    assert html_text.main_text(page(body, teaser, teaser * 3)) == whole
    assert html_text.main_text(page(body, "", "<article><p>A short last part.</p></article>")) == whole + "\nA short last part."
    assert html_text.main_text(page(teaser)) == "Another story to read\nIt begins so."
    for name in ("commentlist", "user-feedback"):
        inside = body.replace("</article>", f"<ol class='{name}'><li>{e}</li></ol></article>")
        assert html_text.main_text(page(inside)) == whole


def test_words_apart_from_where_text_surges():
    a, b, c, d, *_ = ARTICLE
    gap = "<nav><ul><li>x<li>y<li>z</ul></nav>"
    body = f"<div class='a'><p>{a} {b}</p><p>{c}</p><hr>{gap}<p>A last word of the author, with some more of them, long enough.</p></div>"
    last = "A last word of the author, with some more of them, long enough."
    note = "<div class='z'><p>All views are those of their authors, and nobody is liable for any of them.</p></div><nav>y</nav>"
    text = "\n".join([f"{a} {b}", c, last])
    assert html_text.main_text(page(body, "", gap + note)) == text
    assert html_text.main_text(page(note)) == "All views are those of their authors, and nobody is liable for any of them."


def test_deep_nesting_takes_linear_memory():
    import tracemalloc
    peaks = []
    for n in (5_000, 20_000):
        tracemalloc.start()
        text = html_text.main_text("".join(f"<article><p>{i}</p>" for i in range(n)))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert text == "\n".join(map(str, range(n)))
    assert peaks[1] < 6 * peaks[0] and peaks[1] < 60 << 20


def test_extract(spark):
    rows = [(1, "u", page(f"<article><p>{ARTICLE[2]}</article>"), "clash"), (1, "u", None, "clash"), (None, None, "", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extract(df)
    assert Counter(map(tuple, got.collect())) == Counter([(1, "u", ARTICLE[2], len(ARTICLE[2])), (1, "u", "", 0), (None, None, "", 0)])
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert html_text.extract(df.filter("page_id > 5")).collect() == []


# ------------------------------------------------------------------- vectors
def brute_links(rows):
    ok = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    links, n = [], [0] * len(rows)
    for x in range(len(rows)):
        for y in range(x):
            if ok[x] and ok[y] and len(rows[x][1]) == len(rows[y][1]):
                a, b = (np.array(rows[i][1], dtype=np.float64) for i in (x, y))
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= vector_dup.THRESHOLD:
                    links.append((x, y))
                    n[x] += 1
                    n[y] += 1
    comp = components(range(len(rows)), links)
    least = {}
    for i, c in comp.items():
        if rows[i][0] is not None:
            least[c] = min(least.get(c, rows[i][0]), rows[i][0])
    return Counter((i, n[k], least.get(comp[k]) if ok[k] else i, i == (least.get(comp[k]) if ok[k] else i)) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("block", [16, 8192])
def test_vectors_are_all_compared(spark, monkeypatch, block):
    monkeypatch.setattr(vector_dup, "BLOCK", block)
    monkeypatch.setattr(vector_dup, "STRIP", 7)
    monkeypatch.setattr(vector_dup, "PAIRS", 50)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 40))
    rows = [(int(i), (centres[i % 12] + rng.normal(size=40) * [0.05, 0.3, 0.6][i % 3]).tolist()) for i in range(150)]
    rows += [(200 + i, rows[5][1]) for i in range(30)]                       # one very common vector
    rows += [(300, [0.0] * 40), (301, None), (302, []), (303, [1.0, 2.0]), (304, [2.0, 4.1]), (305, [float("nan")] * 40),
             (306, [float("inf")] + [1.0] * 39), (307, [None] + [1.0] * 39), (5, rows[7][1]), (None, rows[7][1]),
             (None, [-x for x in rows[7][1]]), (308, [1e-300 * x for x in rows[9][1]]), (309, [1e200 * x for x in rows[9][1]])]
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows], "vec_id long, embedding array<double>, node string")
    got = vector_dup.link_vectors(df.repartition(3)).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == brute_links(rows)
    assert vector_dup.link_vectors(df.filter("vec_id < 0")).collect() == []


def test_links_at_the_threshold(spark):
    a = np.zeros(20)
    a[0] = 1.0
    rows = [(0, a.tolist())]
    for i, cosine in enumerate((0.9 + 1e-9, 0.9 - 1e-9, 0.95, 0.5, -0.95)):
        v = np.zeros(20)
        v[0], v[i + 1] = cosine, math.sqrt(1 - cosine * cosine)
        rows.append((i + 1, v.tolist()))
    got = {r.vec_id: r.n_links for r in vector_dup.link_vectors(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {0: 2, 1: 1, 2: 0, 3: 1, 4: 0, 5: 0}
