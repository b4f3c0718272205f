"""Main text of web pages by line-block distribution.

Markup is stripped so that every block element becomes a line; elements that are
no article text by name, role or class (menus, page headers and footers, side
bars, notices, adverts, forms, scripts, reader comments) leave blank lines, and so
do the edges of containers, one for each.  No element with over half of the
page's text is taken out that way, whatever it is called.

The text lengths of the lines, links counted against them, are summed over a
sliding window.  The sum *surges* where a window holds ``SURGE`` characters and
*dives* where one holds fewer than ``DIVE``; the text between a surge and its
dive, without short unmarked lines at its edges, is a core.  A stretch of lines
without a gap of a whole window is chosen if its cores hold paragraphs or
headings of ``SURGE`` characters, or ``BARE`` characters of any kind; all text between
the first and the last chosen stretch stays, and so do paragraphs and headings
beside them in a container of chosen text.  A page that surges nowhere gives the
paragraphs it has, or else what text it has.

Marked articles are a check afterwards: if a chosen stretch lies in one, the text
is that of the marked articles, all of it; if none does (articles that are teasers
beside the text), the choice stands.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import slices

WINDOW_LINES = 3
#: Characters in a window at which text begins, and below which it ends.
SURGE, DIVE = 60, 10
#: Characters of a stretch that is chosen without a paragraph or heading; a shorter line of no such element is no prose.
BARE, SHORT = 200, 60

# Element names and the words of class, id and role that mark what is no article text.
BLOCKS = frozenset("""address article aside blockquote body center dd details dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead
    tr ul""".split())
PARAGRAPHS = frozenset(["p", "blockquote", "pre", "dd", "h1", "h2", "h3", "h4", "h5", "h6"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset("""applet aside button datalist dialog footer form head header iframe input label legend map menu nav
    noscript object optgroup option select template textarea title""".split())
NO_TEXT_WORDS = frozenset("""ad ads adv advert adverts advertisement adsense alert banner breadcrumb breadcrumbs comment
    comments complementary consent contentinfo cookie cookies copyright dialog disclaimer disqus feedback footer form
    gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager
    pagination popup privacy promo promotion recommended related replies reply respond search share sharing shop sidebar
    signup social sponsor sponsored subscribe subscription tags toolbar toc tooltip warning widget""".split())
REMARK_WORDS = frozenset("ad ads advert comment comments promo related reply".split())
HEADER_WORDS = frozenset(["header", "masthead", "banner"])
UNMARKED = frozenset(["b", "i", "em", "strong", "u", "a", "br", "img", "html", "body", "main", "h1"])

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|svg|math|noembed|noframes|xmp)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*>"
    r"|</?[a-zA-Z][^<>]*\Z", re.S | re.I)
#: Elements that are never article text, however much they hold: menus, and what a page doesn't show as text.
UNSEEN = frozenset("applet datalist head iframe input legend map menu nav noscript object optgroup option select template textarea title".split())
#: Containers of lines; a line's own element (a paragraph, a heading, an item) is none.
CONTAINERS = frozenset("article aside blockquote body center dd details div fieldset main section td th".split())
#: First parts of a class that say what the element has or lacks, not what it is.
ABOUT = frozenset("has have no not show with without".split())
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
WORD = re.compile(r"[a-z]+")


def _no_text(name: str, attributes: str, in_article: bool, listing: frozenset) -> int:
    """Whether an element that opens holds no article text: 0 no, 1 by its name, role or class
    unless it wraps the page's text, 2 whatever it holds."""
    if name in UNSEEN:
        return 2
    if name in NO_TEXT and not (name == "header" and in_article):
        return 1
    if name in UNMARKED or "=" not in attributes:
        return 0
    listed = listing & REMARK_WORDS if name == "article" else listing - HEADER_WORDS if in_article else listing
    for _, value in ATTRIBUTE.findall(attributes):
        for token in value.lower().strip("\"'").split():
            words = WORD.findall(token)
            about = next((i for i, w in enumerate(words) if w in ABOUT), len(words))
            if token in listed or not listed.isdisjoint(words[:about]):
                return 1
    return 0


def _wrappers(html: str) -> set[int]:
    """Starts of the elements with over half of the page's text."""
    opened: list[tuple[str, int, int]] = []  # name, start, text before
    names: dict[str, int] = {}
    sizes, text, at = [], 0, 0
    for m in MARKUP.finditer(html):
        text += len(html[at:m.start()].strip())
        at = m.end()
        name = (m[3] or m[6] or "").lower()
        if not name or name in VOID:
            continue
        if not (m[2] or m[5]):
            opened.append((name, m.start(), text))
            names[name] = names.get(name, 0) + 1
        elif names.get(name):
            last = ""
            while last != name:
                last, start, before = opened.pop()
                names[last] -= 1
                sizes.append((start, text - before))
    text += len(html[at:].strip())
    sizes += [(start, text - before) for _, start, before in opened]
    return {start for start, n in sizes if 2 * n > text}


class _Page:
    """Lines of a page: text, length without links, whether inside a marked article, start of its container."""

    def __init__(self):
        self.lines: list[tuple[str, int, bool]] = []
        self.kinds: list[str] = []  # the paragraph or heading element of each line, "" for none
        self.kind = ""
        self.holders: list[int] = []  # the container of each line
        self.up: dict[int, int] = {}  # the container of each container
        self.open: list[tuple[str, int]] = []
        self.opened: dict[str, int] = {}
        self.parts: list[str] = []
        self.linked = 0
        self.in_link = 0
        self.article = 0

    def text(self, s: str) -> None:
        if s:
            self.parts.append(s)
            if self.in_link:
                self.linked += len(s)

    def end_line(self) -> None:
        if self.parts:
            line = " ".join(unescape("".join(self.parts)).split())
            if line:
                self.lines.append((line, max(len(line) - self.linked, 0), self.article > 0))
                self.holders.append(self.holder())
                self.kinds.append(self.kind)
            self.parts.clear()
        self.linked = 0

    def gap(self, lines: int = WINDOW_LINES) -> None:
        self.end_line()
        self.lines += [("", 0, self.article > 0)] * lines
        self.holders += [-1] * lines
        self.kinds += [""] * lines

    def holder(self) -> int:
        return self.open[-1][1] if self.open else -1

    def enter(self, name: str, start: int) -> None:
        self.gap(1)
        self.up[start] = self.holder()
        self.open.append((name, start))
        self.opened[name] = self.opened.get(name, 0) + 1

    def leave(self, name: str) -> None:
        self.gap(1)
        last = ""
        while last != name and self.opened.get(name):
            last = self.open.pop()[0]
            self.opened[last] -= 1


def lines_of(html: str) -> list[tuple[str, int, bool]]:
    """The page as lines; blank ones stand where elements without article text were."""
    return _read(html).lines


def _read(html: str, listing: frozenset = NO_TEXT_WORDS) -> _Page:
    page, at, wrappers = _Page(), 0, None
    skipped, depth = "", 0  # the element that is being left out, and how deep it is nested in itself
    for m in MARKUP.finditer(html):
        start, end = m.span()
        if not skipped:
            page.text(html[at:start])
        at = end
        name = m[3] or m[6]
        if not name:
            continue
        name, closing = name.lower(), bool(m[2] or m[5])
        if skipped:
            if name == skipped and name not in VOID:
                depth += -1 if closing else 1
                if skipped == "p" and not closing:
                    depth = 0
            elif not closing and (skipped == "p" and name in BLOCKS
                                  or name in ("article", "main") and skipped in ("nav", "header", "footer", "form", "head")
                                  or name == "body" and skipped in ("head", "title")):
                depth = 0
            elif closing and name in ("body", "html"):
                depth = 0
            if depth:
                continue
            done, skipped = closing, ""
            page.gap()
            if done or name in VOID:
                continue
        if closing:
            if name in BLOCKS:
                page.end_line()
                page.kind = ""
            if name in CONTAINERS:
                page.leave(name)
            if name in ("article", "main") and page.article:
                page.article -= 1
                if not page.article:
                    page.gap()
            elif name == "a":
                page.in_link = 0
            continue
        attributes = m[4] or m[7] or ""
        if name in BLOCKS:
            page.end_line()
            page.kind = name if name in PARAGRAPHS else ""
        out = _no_text(name, attributes, page.article > 0, listing)
        if out == 1:
            wrappers = _wrappers(html) if wrappers is None else wrappers
            out = start not in wrappers
        if out:
            if name in VOID or attributes.endswith("/"):
                continue
            skipped, depth = name, 1
            continue
        if name in CONTAINERS:
            page.enter(name, start)
        if name in ("article", "main"):
            if not page.article:
                page.gap()
            page.article += 1
        elif name == "br":
            page.text(" ")
        elif name == "a":
            page.in_link = 1
    if not skipped:
        page.text(html[at:])
    page.end_line()
    return page


def stretches(lengths: list[int], window: int = WINDOW_LINES, surge: int = 1, dive: int = 1) -> list[tuple[int, int]]:
    """(surge, dive) of each stretch: from the first line with text of a window whose sum reaches ``surge``
    to the last line with text of one whose sum is below ``dive`` (or of the page)."""
    found, total, begin, last = [], 0, None, 0
    for i, n in enumerate([*lengths, *[0] * window]):
        total += n - (lengths[i - window] if i >= window else 0)
        if begin is None and total >= surge:
            begin = next(k for k in range(max(i - window + 1, last), i + 1) if lengths[k])
        if begin is not None and total < dive:
            found.append((begin, last))
            begin = None
        elif n and begin is not None:
            last = i + 1
    if begin is not None:
        found.append((begin, last))
    return found


def _prose(page: _Page, i: int, lengths: list[int]) -> bool:
    """Whether a line is a paragraph, a heading or as long as one."""
    return bool(page.kinds[i]) or lengths[i] >= SHORT


def _core(page: _Page, a: int, b: int, lengths: list[int]) -> tuple[int, int] | None:
    """The part of a stretch from its first surge to its last dive, with the paragraphs and headings
    before and after it, without short unmarked lines at the edges."""
    cores = stretches(lengths[a:b], WINDOW_LINES, SURGE, DIVE)
    if not cores:
        return None
    s, e = a + cores[0][0], a + cores[-1][1]
    s = next((i for i in range(a, s) if page.kinds[i]), s)
    e = next((i + 1 for i in range(b - 1, e - 1, -1) if page.kinds[i]), e)
    while s < e and not _prose(page, s, lengths):
        s += 1
    while s < e and not _prose(page, e - 1, lengths):
        e -= 1
    # the page's heading begins its text: what stands before it without being a paragraph is something else
    top = next((i for i in range(s, e) if page.kinds[i] == "h1"), None)
    if top is not None and not any(page.kinds[s:top]) and sum(lengths[s:top]) < sum(lengths[top:e]):
        s = top
    marked = sum(n for n, kind in zip(lengths[s:e], page.kinds[s:e]) if kind)
    return (s, e) if marked >= SURGE or sum(lengths[s:e]) >= BARE else None


def main_text(html: str | None, listing: frozenset = NO_TEXT_WORDS, check_marked: bool = True) -> str:
    """The article's blocks in page order, joined by an empty line; "" if there is none.

    ``listing`` are the words of class, id and role that pre-clean a page;
    ``check_marked`` is the check against marked articles afterwards.
    """
    if not html:
        return ""
    page = _read(html, listing)
    lines = page.lines
    # a link's text counts against its line; in a marked article a line of links only is still its text
    lengths = [len(text) if inside and check_marked else max(2 * free - len(text), 0) for text, free, inside in lines]
    found = stretches(lengths)
    if not found:
        return ""
    cores = {(a, b): _core(page, a, b, lengths) for a, b in found}
    chosen = [c for c in cores.values() if c] or [x for x in found if any(page.kinds[x[0]:x[1]])] or found
    if check_marked and any(lines[a][2] for a, _ in chosen):
        kept = [(a, b) for a, b in found if lines[a][2]]
    else:
        # short ones stay between the chosen, and paragraphs where their container holds chosen text
        around = {-1}
        for a, b in chosen:
            for h in page.holders[a:b]:
                while h not in around:
                    around.add(h)
                    h = page.up[h]
        first, last = chosen[0][0], chosen[-1][1]
        kept = []
        for (a, b), core in cores.items():
            if core or first <= a < last or (a, b) in chosen:
                kept.append(core or (a, b))
            elif any(page.kinds[i] and page.holders[i] in around for i in range(a, b)):
                kept.append((a, b))
    return "\n\n".join(text for a, b in kept for text, _, _ in lines[a:b] if text)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without ``html_col`` and with ``text`` (main text) and ``n_chars`` (its code points).

    A NULL or empty page gives an empty text.  Pages are read one by one:
    repeated rows get equal results, an empty table an empty result; columns
    that have the name of a result column are replaced.
    """
    made = {"text": T.StringType(), "n_chars": T.LongType()}
    carried = [c for c in pages.columns if c not in made and c != html_col]
    schema = T.StructType([*[pages.schema[c] for c in carried], *[T.StructField(c, t) for c, t in made.items()]])

    def run(batches):
        import pyarrow as pa

        for whole in batches:
            for batch in slices(whole, 8 << 20, html_col):
                texts = [main_text(h) for h in batch.column(batch.schema.get_field_index(html_col)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(batch.schema.get_field_index(c)) for c in carried], pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=[*carried, *made])

    return pages.select(*[F.col(f"`{c}`") for c in [*carried, html_col]]).mapInArrow(run, schema)
