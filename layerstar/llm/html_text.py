"""Main text of HTML pages by line-block distribution."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerstar.llm.common import map_arrow

#: Lines of a window, and the least text of a surge (characters outside links), however dense
#: the rest of the page is.
LINES, SURGE_CHARS = 3, 60
#: Of several stretches or articles, one whose peak is below this share of the highest is weak.
WEAK_SHARE = 0.25

# One piece of markup.  A quoted value may hold "<" and ">" up to the end of its line; the parts are matched
# without going back (a quote that is not closed there is a character like others).
_MARKUP = re.compile(r"""<!--.*?-->|<!--.*\Z|<(/?)([a-zA-Z][^\s<>/]*+)((?:[^<>"']++|"[^"\n]*+"|'[^'\n]*+'|["'])*+)>|<[!?][^<>]*+>""",
                     re.S)
# One attribute: its name and value
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
_HINTS = frozenset("class id role itemprop style aria-hidden hidden".split())
_HINT = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIPPED = frozenset("""nav header footer aside form script style noscript template button select textarea iframe svg canvas
    object audio video dialog menu head title xmp noembed noframes math map""".split())
#: Elements that some pages put round the whole article: they count as others where it stands inside.
_WRAPPERS = frozenset("form dialog header aside".split())
_BLOCKS = frozenset("""address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody tfoot
    thead tr ul caption center""".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Class and id names, roles and itemprops that mark what is not the article: these words, such a word
#: at the end of a longer name (reader-comments), or together with words of _PLACES alone (ad-slot).
_AWAY = frozenset("""nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar footer masthead banner cookie cookies consent
    gdpr ad ads advert adverts advertisement advertising sponsor sponsored promo popup modal overlay newsletter subscribe
    signup share sharing social related recommended recommendations comment comments commentlist feedback disqus replies respond notice notices
    alert toolbar widget widgets pagination pager login search searchbox copyright contentinfo complementary tooltip
    dialog paywall teaser outbrain taboola skip""".split())
#: What the parts of a page are called.
_PLACES = frozenset("""area article articles bar block body bottom box button buttons card cards column container content form
    frame group header heading holder icon icons inner item items left link links list main module outer page panel post posts
    right row section site slot stories story text thread title top unit wrap wrapper""".split())
#: Words that make a longer name a state (has-comments) or a title (notes-on-search), and no mark.
_STATES = frozenset("""a about allow and by disable disabled enable enabled for has have hide how if in is no non not of off on or
    show the to use uses with without""".split())
#: Of _AWAY, words of places that list other articles: an article inside counts only where the page has no other.
_LISTS = frozenset("""comment comments commentlist feedback disqus replies respond related recommended recommendations teaser promo sponsor
    sponsored outbrain taboola""".split())
#: Words that mark an article element as something smaller.
_NOT_AN_ARTICLE = frozenset("comment comments teaser ad promo related".split())
#: Words that mark the article where no article or main element does.
_MAIN = frozenset("article articlebody post story entry content maintext".split())


@dataclass
class _Line:
    """A block of the page: text outside and inside links, and where it stands."""

    parts: list = field(default_factory=list)
    linked: int = 0
    skipped: bool = False
    inside: int = -1               # the innermost element of the main text, -1: none
    container: int = -1            # where the element stands that holds it
    heading: bool = False


@dataclass
class _Page:
    """The blocks of a page, and what its elements are."""

    lines: list[_Line] = field(default_factory=list)
    kinds: list[str] = field(default_factory=list)            # of each main-text element: article, main or hint
    roots: list[dict] = field(default_factory=list)           # and the outermost of each kind that it stands in
    barred: bool = False                                      # names alone kept an article or main element out
    any_marks: bool = False
    wrapped: dict = field(default_factory=dict)               # start of a wrapper: [characters in it, holds an article]

    def root(self, line: _Line, kind: str) -> int:
        """The outermost element of the kind that the line stands in, or -1."""
        return self.roots[line.inside].get(kind, -1) if line.inside >= 0 else -1


def _marks(name: str) -> set:
    """Words of _AWAY by which a class, id, role or itemprop marks its element."""
    words = [w.lower() for w in _HINT.findall(name)]
    found = _AWAY.intersection([name.lower(), *words])
    if not found or name.lower() in _AWAY:
        return found
    if not _STATES.isdisjoint(words) or words[-1] not in _AWAY and not _AWAY.union(_PLACES).issuperset(words):
        return set()
    return found


def _attributes(attrs: str, titled: bool) -> tuple[bool, frozenset, frozenset]:
    """(hidden, words of class, id, role and itemprop, marks); ``titled``: the id is made of a title and marks nothing."""
    if not attrs or attrs.isspace():
        return False, frozenset(), frozenset()
    hidden, words, marks = False, set(), set()
    for name, value in _ATTRIBUTE.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name not in _HINTS:
            continue
        if name == "hidden":
            hidden = True
        elif name == "aria-hidden":
            hidden |= value.lower() == "true"
        elif name == "style":
            hidden |= re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) is not None
        else:
            words.update(w.lower() for w in _HINT.findall(value))
            words.add(value.lower())
            if not (titled and name == "id"):
                for token in value.split():
                    marks |= _marks(token)
    return hidden, frozenset(words), frozenset(marks)


def _lines(page: str, lift: bool = False, marked: bool = True, lifted: frozenset = frozenset()) -> _Page:
    """The page's blocks in order, and its main-text elements.

    ``lift``: an article counts in whatever is marked by name; without ``marked``, names mark nothing;
    ``lifted``: where the wrappers start that are elements like others.
    """
    out = _Page()
    lines, kinds, line = out.lines, out.kinds, _Line()
    # (tag, and skipping, hard, listed, inside, wrapper and container as they were before it)
    stack: list[tuple] = []
    open_tags: dict[str, int] = {}
    # skipping: open elements that are left out; of these, hard: for good, by element, and listed, by name
    skipping, hard, listed, links, inside = 0, 0, 0, 0, -1
    # the open wrappers that are left out (how many, where the innermost starts), and where the innermost block and
    # the one round it start
    wrapper, container = (0, -1), (-1, -1)
    heading = 0                                    # open headings: kept in an article's own header

    def close_line() -> None:
        nonlocal line
        if line.parts or line.skipped:
            lines.append(line)
        line = _Line(skipped=skipping > 0, inside=inside, container=container[1])

    def closed(top: tuple) -> None:
        """What stood in a wrapper stands in the one round it as well."""
        (_, start), (_, outer) = wrapper, top[5]
        if start != outer and start in out.wrapped and outer in out.wrapped:
            out.wrapped[outer][0] += out.wrapped[start][0]
            out.wrapped[outer][1] |= out.wrapped[start][1]

    def text(s: str) -> None:
        if s and skipping and skipping == wrapper[0]:          # left out for wrappers alone
            out.wrapped[wrapper[1]][0] += len(s.strip())
        if s and (skipping == 0 or (skipping == 1 and heading and in_header)):
            line.parts.append(s)
            line.heading |= heading > 0
            if links:
                line.linked += len(s.strip())

    in_header = 0
    at, end = 0, len(page)
    while at < end:
        m = _MARKUP.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:                                   # a closing tag
            if tag == "p" and not open_tags.get("p"):
                close_line()
            if not open_tags.get(tag):
                continue
            if tag in _BLOCKS:
                close_line()
            while True:
                entry = stack.pop()
                closed(entry)
                top, skipping, hard, listed, inside, wrapper, container = entry
                open_tags[top] -= 1
                links -= top == "a"
                heading -= top in _HEADINGS
                in_header -= top == "header" and skipping == 0 and inside >= 0
                if top == tag:
                    break
            if tag in _BLOCKS:
                line.skipped, line.inside, line.container = skipping > 0, inside, container[1]
            continue
        if tag == "br":
            text(" ")
            continue
        if tag in ("td", "th"):
            text(" ")
        hidden, words, marks = _attributes(m[3], tag in _HEADINGS or tag == "section" and inside >= 0)
        if tag in _VOID:
            if tag == "hr":
                close_line()
            continue
        if tag in _BLOCKS:
            close_line()
            if open_tags.get("p"):                 # a block ends an open paragraph
                while True:
                    entry = stack.pop()
                    closed(entry)
                    top, skipping, hard, listed, inside, wrapper, container = entry
                    open_tags[top] -= 1
                    links -= top == "a"
                    heading -= top in _HEADINGS
                    if top == "p":
                        break
        if tag == "body":                          # whatever was left open before it
            stack, open_tags, skipping, hard, listed, links, heading, inside = [], {}, 0, 0, 0, 0, 0, -1
            wrapper, container = (0, -1), (-1, -1)
        stack.append((tag, skipping, hard, listed, inside, wrapper, container))
        open_tags[tag] = open_tags.get(tag, 0) + 1
        links += tag == "a"
        heading += tag in _HEADINGS
        own_header = tag == "header" and skipping == 0 and inside >= 0
        in_header += own_header
        main = tag in ("article", "main") or "main" in words and ("role" in m[3].lower()) or "articlebody" in words
        if tag in ("html", "body", "main", "article"):
            marks &= _NOT_AN_ARTICLE
        out.any_marks |= bool(marks)
        gone = tag in _SKIPPED and m.start() not in lifted or hidden
        away = gone or marked and bool(marks)
        if main and not away and not hard:         # only names stand against it
            if lift or not listed:
                skipping = listed = 0
            else:
                out.barred = True
        if main and not away and skipping and skipping == wrapper[0]:
            out.wrapped[wrapper[1]][1] = True
        if (gone and not hidden and not (marked and marks) and tag in _WRAPPERS and inside < 0
                and skipping == wrapper[0] and (tag != "dialog" or re.search(r"(?:^|\s)open\b", m[3]))):
            wrapper = (wrapper[0] + 1, m.start())
            out.wrapped[m.start()] = [0, False]
        skipping += away
        hard += gone
        listed += away and not gone and not marks.isdisjoint(_LISTS)
        if not away and not skipping:
            if main:
                kinds.append(tag if tag == "article" else "main")
            elif tag in ("div", "section", "td") and words & _MAIN:
                kinds.append("hint")
            if len(kinds) > len(out.roots):
                out.roots.append({kinds[-1]: len(kinds) - 1, **(out.roots[inside] if inside >= 0 else {})})
                inside = len(kinds) - 1
        if tag in _BLOCKS:
            container = (m.start(), container[0])
            line.skipped, line.inside, line.container = skipping > 0, inside, container[1]
        if tag in _RAW:                            # its content is no markup
            m = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = m.start() if m else end
    close_line()
    while stack:
        entry = stack.pop()
        closed(entry)
        wrapper = entry[5]
    for x in lines:
        x.parts = " ".join(html.unescape("".join(x.parts)).split())
    return out


def _round_the_article(page: _Page, starts: dict) -> frozenset:
    """The wrappers that hold the page's article, if no article or main element stands outside: those with one
    inside (an aside: never for that), or with more text than all the rest of the page."""
    if any(x.parts and (page.root(x, "article") >= 0 or page.root(x, "main") >= 0) for x in page.lines):
        return frozenset()
    rest = sum(len(x.parts) for x in page.lines)
    return frozenset(at for at, (chars, article) in page.wrapped.items()
                     if article and not starts[at].startswith("aside") or chars > max(rest, SURGE_CHARS))


def main_text(page: str | None) -> str:
    """The article's blocks, one a line; see ``extract``."""
    if not page:
        return ""
    read = _lines(page)
    lifted = frozenset()
    if read.wrapped:
        lifted = _round_the_article(read, {at: page[at + 1:at + 7].lower() for at in read.wrapped})
        if lifted:
            read = _lines(page, lifted=lifted)
    if read.barred and not any(x.parts and (read.root(x, "article") >= 0 or read.root(x, "main") >= 0) for x in read.lines):
        read = _lines(page, lift=True, lifted=lifted)
    text = _article(read)
    if not text and read.any_marks:                # names would leave nothing
        text = _article(_lines(page, marked=False, lifted=lifted))
    return text


def _unlinked(line: _Line) -> int:
    """Characters of a line that count where a line of mostly links is a menu."""
    return max(0, len(line.parts) - 2 * line.linked)


def _windows(dense: list[int]) -> list[int]:
    return [sum(dense[i:i + LINES]) for i in range(len(dense))]


def _main_articles(page: _Page, held: dict[int, list[_Line]]) -> set[int]:
    """Of several article elements, all but teasers: those that tell little beside the one in which text
    surges highest, and hold a block of mostly links, as the title of another story is."""
    peaks = {k: max(_windows([len(x.parts) for x in own])) for k, own in held.items()}
    top = max(peaks.values())
    return {k for k, own in held.items()
            if peaks[k] >= WEAK_SHARE * top or not any(x.parts and 2 * x.linked >= len(x.parts) for x in own)}


def _article(page: _Page) -> str:
    """The lines of the article, as text."""
    lines = page.lines
    # the most telling elements that have text: article, then main, then a class or id that says so
    chosen: set[int] = set()
    for kind in ("article", "main", "hint"):
        held: dict[int, list[_Line]] = {}          # the lines of each outermost element
        for x in lines:
            k = page.root(x, kind)
            if k >= 0:
                held.setdefault(k, []).append(x)
        held = {k: own for k, own in held.items() if any(len(x.parts) > x.linked for x in own)}
        if held:
            chosen = _main_articles(page, held) if kind == "article" else set(held)
            if kind != "article":                  # of several, those in which text surges
                peaks = {k: max(_windows([_unlinked(x) for x in own])) for k, own in held.items()}
                chosen = {k for k, n in peaks.items() if n >= min(SURGE_CHARS, max(peaks.values()))}
            break
    if chosen:
        mine = [page.root(x, kind) in chosen for x in lines]
        if kind != "article":                      # and the headings right before the first
            i = mine.index(True) - 1
            while i >= 0 and (lines[i].heading and _unlinked(lines[i]) or not lines[i].parts):
                mine[i] = True
                i -= 1
        lines = [x if own else _Line(parts="", skipped=True) for x, own in zip(lines, mine, strict=True)]
    # inside the element its links are text as well; elsewhere a line of mostly links is a menu
    dense = [len(x.parts) if chosen else _unlinked(x) for x in lines]
    sums = _windows(dense)
    top = max(sums, default=0)
    least = 1 if chosen else min(SURGE_CHARS, top)
    found: list[tuple[int, list[_Line]]] = []
    i = 0
    while i < len(lines):
        if not dense[i]:                           # before a surge
            i += 1
            continue
        first, last, peak = i, i, 0
        while i < len(lines) and sums[i] > 0:      # down to the dive: a window without text
            peak = max(peak, sums[i])
            last = i if dense[i] else last
            i += 1
        if peak >= least:
            found.append((peak, [x for x in lines[first:last + 1] if x.parts]))
    if not chosen:                                 # a few words apart from where text surges, in another element
        strong = WEAK_SHARE * top
        places = {x.container for peak, own in found if peak >= strong for x in own}
        found = [(peak, own) for peak, own in found if peak >= min(strong, 4 * SURGE_CHARS)
                 or any(x.container in places for x in own)]
    return "\n".join(x.parts for _, own in found for x in own)


def _extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            rows = batch.slice(at, 256)
            texts = [main_text(x.as_py()) for x in rows.column(2)]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(texts, pa.string())],
                                             names=["id", "url", "text"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of each page.

    Returns one row per page: ``id_col``, ``url_col``, ``text`` and ``n_chars``.
    Markup is stripped into lines, one per block element; scripts, styles, menus,
    headers, footers, sidebars, notices, adverts, forms and comments (by element,
    role or the names of their class and id) are lines without text.  A name marks an
    element by what it says as a whole: reader-comments and ad-slot do, related-work, ad-hoc and
    has-comments do not, nor do ids of headings and of an article's sections.  An article or main
    element counts inside what a name marks (inside lists of comments or other articles where
    it is the only one), and where names would leave no text at all they mark nothing.  The text
    outside links is summed over windows of LINES lines.  A window that rises
    from nothing starts a stretch, one that falls to nothing ends it, and a
    stretch stays if it surges to SURGE_CHARS, or as high as any does; inside an article or main element every
    window with text does.  Of several articles, those with a linked title in which text surges to less than
    WEAK_SHARE of the highest are teasers of other stories.  Without any article all main elements, or else all
    elements with a name such as entry-content, in which text surges count, and the headings
    right before the first.  Without any of these, a stretch that surges to less than WEAK_SHARE of the highest and
    to less than 4 SURGE_CHARS stays only if a block of it stands in the same element as one of a higher stretch.  A form, an
    open dialog, a header or an aside is an element like others when no article stands outside and it holds one
    (an aside: never for that), or more text than the rest of the page.  White space inside a block becomes one space, blocks
    are joined by line ends.

    A NULL or empty page, or one of markup alone, has an empty text; unclosed and
    cut-off markup is read as far as it goes; ids may be NULL or repeat; an empty
    table gives an empty result; other columns are ignored.
    """
    types = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    done = map_arrow(pages.select(id_col, url_col, html_col), _extract_batches,
                     f"id {types[0]}, url {types[1]}, text string")
    return done.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text",
                       F.length("text").cast("long").alias("n_chars"))
