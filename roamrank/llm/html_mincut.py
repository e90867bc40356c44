"""Main text of web pages by minimum-cut labelling.

A page becomes blocks of text. A logistic classifier over their text and the elements
around them prices each label, which gives the blocks' capacities to the two
terminals. Blocks that follow each other, or share a parent or a region of the
document, are joined by edges that cost something if the labels differ. The maximum
flow's cut is the cheapest labelling; the blocks on the content side, in page order,
are the text.

The classifier is fitted on at most SAMPLE_PAGES pages, those with the smallest hashes
of page_id, and at most SAMPLE_BLOCKS of their blocks each. It learns from pages that
mark their article, with that marking hidden from half of the rows, so that it also
serves pages that don't; if none do, its prior weights hold.

Null html counts as empty, and a page without content has an empty text. Repeated rows
and null ids are handled row by row, extra columns pass through, ``text`` and
``n_chars`` replace columns of these names, and an empty table gives an empty result.
Whole pages are read, in time proportional to their length but for the flow.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamrank.llm.batches import bound_batches, give_back, tidy

SAMPLE_PAGES, SAMPLE_BLOCKS = 400, 100

VOID = frozenset("area base br col embed hr img input link meta source track wbr param keygen".split())
RAW = frozenset("script style title textarea iframe xmp noembed noframes".split())
# Elements that aren't shown as text, if their own end tags close them; what is in one left open is judged like any text.
UNSHOWN = frozenset("noscript template svg select annotation annotation-xml".split())
FOREIGN = frozenset("svg math annotation annotation-xml".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p "
    "pre section summary table tbody td tfoot th thead tr ul".split()
)
#: An open element of the values is closed by a new one of the key.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}} | {
    "th": {"td", "th"},
    "option": {"option"},
}
SCOPE = frozenset("table ul ol dl tbody thead tfoot select html body div section article".split())
NOT_MAIN = frozenset("nav aside footer form menu dialog button fieldset head".split())
MAIN = frozenset(["article", "main"])
FORMS = frozenset("form fieldset dialog button".split())  # may be around a whole page
IN_HEAD = frozenset("title meta link style script base basefont noscript template".split())
# Words in class, id and role: of parts that are hardly the article, of parts that
# are not unless the article lies inside, and of the article's own. A whole token tells
# of a part, alone or with words that name a piece of it; has-comments doesn't.
NEVER = re.compile(
    r"comments?|replies|disqus|ads?|adverts?|advertisements?|sponsor(?:ed|s)?|promos?|promotions?|related|recommended|newsletter|"
    r"subscribe|signup|share|sharing|social|cookies?|consent|gdpr|popup|modal|overlay|breadcrumbs?|pagination|pager|hidden"
)
SELDOM = re.compile(
    r"sidebar|side|header|masthead|footer|nav|navbar|navigation|menu|menubar|banner|toolbar|widgets?|notices?|alert|"
    r"contentinfo|complementary|search|login|copyright|disclaimer"
)
OFTEN = re.compile(r"article|content|main|story|post|entry|body|text")
PIECE = re.compile(
    r"area|bar|block|bottom|box|btn|buttons?|center|container|div|global|group|icons?|inner|items?|js|left|links?|list|"
    r"mobile|outer|page|panel|primary|right|row|secondary|section|site|slot|top|unit|wrap|wrapper|form"
)
OWN = re.compile(r"articles?|content|main|story|stories|posts?|entry|entries|news")  # related-posts, post-comments
SPLIT = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
UNSEEN = re.compile(r"display\s*:\s*none", re.I)
NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
# What stands before an attribute, and one with its value; a quote that is never closed isn't a value.
GAP = re.compile(r"[\s/]*")
PAIR = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|(?!["'])([^\s>]*+)|(.)))?+""", re.S)

#: Prior weights: the bias, then those of ``features``, the first four of which tell of the markup.
PRIOR = np.array([-2.0, -6.0, -8.0, 4.0, 1.5, 0.9, -3.5, 1.0, 0.3, -0.8, 0.3, 0.5, -1.0])
STRUCTURE = slice(1, 5)
SURE = 25.0
NEAR = (1.2, 0.8, 0.5, 0.1)  # edges within a parent, its parent, a region, and across regions


def names(value: str) -> int:
    """What names tell: 2 if hardly the article, 1 if not unless it's inside, -1 if the article, 0 if nothing."""
    found = set()
    for token in value.split():
        words = [w.lower() for w in SPLIT.findall(token)]
        never, seldom, often, piece, own = (
            [bool(x.fullmatch(w)) for w in words] for x in (NEVER, SELDOM, OFTEN, PIECE, OWN)
        )
        if any(never) and all(map(any, zip(never, seldom, piece, own))):
            found.add(2)
        elif any(seldom) and all(map(any, zip(seldom, piece))):
            found.add(1)
        elif any(often):
            found.add(-1)
    return max(found - {-1}, default=-1 if found else 0)


class Page:
    """Blocks of a page and the elements they stand in."""

    def __init__(self, html: str) -> None:
        self.parent, self.tag, self.own, self.named, self.holds, self.region = [-1], ["#"], [0], [0], [False], [0]
        self.texts: list[str] = []
        self.at: list[int] = []
        self.linked: list[int] = []
        self._buffer: list[str] = []
        self._links = 0
        self._stack = [0]
        self._open: dict[str, list[int]] = {}  # the depths of the open elements of a name
        self._unclosed: set[int] = set()
        self._inner: list[tuple[int, int, int]] = []  # unshown elements opened in the buffer: number, pieces, links before
        self._blocks: list[tuple[list[str], int, int]] = []
        self._before: dict[int, int] = {}  # the block that an unshown element interrupts
        self._walls: list[int] = []  # the depths of all that are open
        self._parse(html)
        self._flush()
        for pieces, element, links in self._blocks:
            words = unescape("".join(pieces)).split()
            if words:
                self.texts.append(" ".join(words))
                self.at.append(element)
                self.linked.append(links)

    def _flush(self) -> None:
        blocks, at = [], self._stack[-1] if self._stack else 0
        for element, pieces, links in reversed(self._inner):
            blocks.append((self._buffer[pieces:], at, self._links - links))
            del self._buffer[pieces:]
            self._links, at = links, self.parent[element]
            self._before[element] = len(self._blocks)
        blocks.append((self._buffer, at, self._links))
        # Those before the last may go on, so they are kept though they hold nothing yet.
        self._blocks += [b for b in reversed(blocks) if b[0] or self._inner]
        for number, (element, _, _) in enumerate(self._inner):
            self._before[element] += number
        self._buffer, self._links, self._inner = [], 0, []

    def _text(self, text: str) -> None:
        if text:
            if self._open.get("head") and not text.isspace():
                self._end_head()
            self._buffer.append(text)
            if self._open.get("a"):
                self._links += len(text)

    def _push(self, name: str, attributes: str) -> None:
        kind = 3 if name in NOT_MAIN else int(name == "header")
        named = 0
        good = name in MAIN
        if attributes and name not in ("html", "body"):
            of: dict[str, str] = {}
            for m in PAIR.finditer(attributes):
                of.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
            if "hidden" in of or UNSEEN.search(of.get("style", "")):
                kind = 2
            named = names(" ".join(of.get(x, "") for x in ("class", "id", "role")))
        up = self._stack[-1]
        here = len(self.tag)
        self.parent.append(up)
        self.tag.append(name)
        self.own.append(kind)
        self.named.append(named)
        self.holds.append(False)
        self.region.append(here if kind > 0 or named > 0 or good else self.region[up])
        if good or name == "h1":
            while up >= 0 and not self.holds[up]:
                self.holds[up] = True
                up = self.parent[up]
        if name in UNSHOWN:
            self._walls.append(len(self._stack))
            self._inner.append((here, len(self._buffer), self._links))
        self._open.setdefault(name, []).append(len(self._stack))
        self._stack.append(here)

    def _pop(self, closed: str = "") -> str:
        element = self._stack.pop()
        name = self.tag[element]
        self._open[name].pop()
        if name in UNSHOWN:
            self._walls.pop()
            pieces = links = 0
            if self._inner and self._inner[-1][0] == element:
                _, pieces, links = self._inner.pop()
            if name == closed:
                if element in self._before:
                    self._buffer, _, self._links = self._blocks[self._before[element]]
                    del self._blocks[self._before[element] :]
                else:
                    del self._buffer[pieces:]
                    self._links = links
        return name

    def _pop_inner(self, name: str) -> None:
        """Close the last open element of a name and what is in it, unless an unshown element began within."""
        depths = self._open[name]
        if depths and depths[-1] > self._wall():
            depth = depths[-1]
            while len(self._stack) > depth:
                self._pop()

    def _end_head(self) -> None:
        """What can't be in a head ends it, as its end tag may be left out."""
        self._flush()
        self._pop_inner("head")

    def _wall(self) -> int:
        return self._walls[-1] if self._walls else 0

    def _start(self, name: str, attributes: str) -> None:
        if name == "br":
            self._buffer.append(" ")
            return
        if name not in IN_HEAD and self._open.get("head"):
            self._end_head()
        if name == "select":
            self._flush()
        if name in BLOCK:
            self._flush()
            if self._open.get("p"):  # a paragraph ends where another block begins
                self._pop_inner("p")
            if self._open.get("option") and name not in ("optgroup", "hr"):
                self._pop_inner("option")
            if name in CLOSES:
                depth = len(self._stack) - 1
                while depth > self._wall() and self.tag[self._stack[depth]] not in SCOPE:
                    if self.tag[self._stack[depth]] in CLOSES[name]:
                        while len(self._stack) > depth:
                            self._pop()
                        break
                    depth -= 1
        if name not in VOID:
            self._push(name, attributes)

    def _end(self, name: str) -> None:
        if name in BLOCK:
            self._flush()
        if self._open.get(name):
            while self._pop(name) != name:
                pass

    def _tag_end(self, html: str, at: int) -> int:
        """The sign that ends a tag whose name ends at a place: the first that is in no quoted value.

        If a quote is never closed it's the first of all. Places from which that was
        found stay known, so many such tags take no longer than one.
        """
        first = html.find(">", at)
        if first < 0 or ('"' not in (tag := html[at:first]) and "'" not in tag):
            return first
        passed = []
        while True:
            at = GAP.match(html, at).end()
            if at == len(html):
                return -1
            if html[at] == ">":
                return at
            if at in self._unclosed:
                break
            passed.append(at)
            pair = PAIR.match(html, at)
            if pair[5]:
                break
            at = pair.end()
        self._unclosed.update(passed)
        return first

    def _parse(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            lt = html.find("<", at)
            if lt < 0:
                self._text(html[at:])
                return
            m = NAME.match(html, lt + 1)
            if not m:
                if html.startswith("<!--", lt):
                    self._text(html[at:lt])
                    end = html.find("-->", lt + 4)
                    at = n if end < 0 else end + 3
                elif html.startswith(("<!", "<?", "</"), lt):
                    self._text(html[at:lt])
                    end = html.find(">", lt)
                    at = n if end < 0 else end + 1
                else:  # a sign, no tag
                    self._text(html[at : lt + 1])
                    at = lt + 1
                continue
            self._text(html[at:lt])
            end = self._tag_end(html, m.end())
            if end < 0:
                return  # the page breaks off in a tag
            name, attributes = m[1].lower(), html[m.end() : end]
            at = end + 1
            if html[lt + 1] == "/":
                self._end(name)
            elif name in RAW and not attributes.endswith("/") and not (name == "title" and self._open.get("svg")):
                if name in ("textarea", "title"):
                    self._flush()
                close = re.compile(f"</{name}(?=[\\s/>])", re.I).search(html, at)
                gt = html.find(">", close.end()) if close else -1
                at = n if gt < 0 else gt + 1
            elif not (name in FOREIGN and attributes.endswith("/")):
                self._start(name, attributes)

    def _vetoes(self) -> tuple[list[bool], list[bool]]:
        """For each element: does its tag, or that it's hidden, settle that it's not the article, or only speak against it.

        A tag settles nothing where the article lies inside: a form around the page, a navigation left open.
        """
        many = len(self.tag)
        inside, below = ([False] * many for _ in range(2))
        free = [True] * many
        articles, outside, every = ([0] * many for _ in range(3))
        shut = [k == 2 or (k == 3 and t not in FORMS) or (k == 1 and not h) for k, t, h in zip(self.own, self.tag, self.holds)]
        for e in range(1, many):
            up, kind = self.parent[e], self.own[e]
            free[e] = free[up] and self.named[e] <= 0
            inside[e] = kind != 2 and ((self.tag[e] in MAIN and free[up]) or (inside[up] and kind != 3 and not shut[e]))
            below[e] = below[up] or shut[e]
        for text, e in zip(self.texts, self.at, strict=True):
            every[e] += len(text)
            articles[e] += len(text) if inside[e] else 0
            outside[e] += 0 if below[e] else len(text)
        for e in range(many - 1, 0, -1):
            for chars in (articles, outside, every):
                chars[self.parent[e]] += chars[e]
        against = [False] * many
        for e in range(1, many):
            if self.own[e] == 3:
                if self.tag[e] not in FORMS:
                    against[e] = 2 * articles[e] > every[0]
                    shut[e] = not against[e]
                elif articles[0]:
                    shut[e] = 2 * articles[e] <= articles[0]
                else:
                    shut[e] = 2 * outside[e] <= outside[0]
        return shut, against

    def marks(self) -> tuple[list[bool], list[bool], list[bool], list[bool]]:
        """For each element: is it, by its tag or its names, in a part that isn't the article, and in one that is."""
        many = len(self.tag)
        tag_bad, name_bad, wary, good, often = ([False] * many for _ in range(5))
        shut, against = self._vetoes()
        free = [True] * many  # no names speak against it
        chars = [0] * many
        main = [tag == "main" for tag in self.tag]
        for e in range(1, many):
            up = self.parent[e]
            tag_bad[e] = tag_bad[up] or shut[e]
            wary[e] = (wary[up] or against[e]) and self.tag[e] not in MAIN
            free[e] = free[up] and self.named[e] <= 0
        for text, e in zip(self.texts, self.at, strict=True):
            chars[e] += 0 if tag_bad[e] else len(text)
        for e in range(many - 1, 0, -1):
            chars[self.parent[e]] += chars[e]
            main[self.parent[e]] |= main[e]
        marked = any(self.tag[e] in MAIN and free[self.parent[e]] and chars[e] for e in range(1, many))
        for e in range(1, many):
            up, tag, named = self.parent[e], self.tag[e], self.named[e]
            # Names say nothing of an article, of what it lies in, and of most of the text of a page that marks none.
            bad = named > 0 and not (tag in MAIN or main[e] or (named == 1 and self.holds[e]))
            bad = bad and (marked or 2 * chars[e] < chars[0])
            name_bad[e] = name_bad[up] or bad
            good[e] = good[up] or tag in MAIN
            often[e] = often[up] or named == -1
        return tag_bad, [a or b for a, b in zip(name_bad, wary, strict=True)], good, often


SENTENCE = re.compile(r"[.!?…:;\"'”»)]$")
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])


def features(page: Page) -> np.ndarray:
    """One row for each block: the bias, four of the markup, and those of the text and its neighbours."""
    tag_bad, name_bad, good, often = page.marks()
    n = len(page.texts)
    x = np.zeros((n, len(PRIOR)))
    for i, (text, e) in enumerate(zip(page.texts, page.at, strict=True)):
        words = text.count(" ") + 1
        density = min(1.0, page.linked[i] / max(1, len(text)))
        x[i, :11] = (
            1, tag_bad[e], name_bad[e], good[e], often[e], np.log1p(words), density,
            bool(SENTENCE.search(text)), page.tag[e] in HEADINGS, page.tag[e] == "li", text.count(",") / words,
        )
    if n > 1:
        around = np.zeros((n, 2))
        around[1:] += x[:-1, 5:7]
        around[:-1] += x[1:, 5:7]
        around[1:-1] /= 2
        x[:, 11:13] = around
        x[:, 11] = x[:, 11] / 4
    return x


def max_flow_side(n: int, source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes a minimum cut leaves on the source's side; edges cost the same either way.

    What flows from the source straight through a node to the sink is settled first;
    the rest is sent along shortest paths by layers until none is left.
    """
    excess = [a - b for a, b in zip(source, sink, strict=True)]
    s, t = n, n + 1
    to: list[int] = []
    room: list[float] = []
    arcs: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, forth: float, back: float) -> None:
        arcs[a].append(len(to))
        to.append(b)
        room.append(forth)
        arcs[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, e in enumerate(excess):
        if e > 0:
            join(s, i, e, 0.0)
        elif e < 0:
            join(i, t, -e, 0.0)
    for a, b, w in edges:
        join(a, b, w, w)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for k in arcs[a]:
                if room[k] > tiny and level[to[k]] < 0:
                    level[to[k]] = level[a] + 1
                    queue.append(to[k])
        if level[t] < 0:
            return [x >= 0 for x in level[:n]]
        step = [0] * (n + 2)
        path: list[int] = []
        a = s
        while True:
            if a == t:
                flow = min(room[k] for k in path)
                cut = len(path)
                for i, k in enumerate(path):
                    room[k] -= flow
                    room[k ^ 1] += flow
                    if room[k] <= tiny and i < cut:
                        cut = i
                a = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while step[a] < len(arcs[a]):
                k = arcs[a][step[a]]
                if room[k] > tiny and level[to[k]] == level[a] + 1:
                    path.append(k)
                    a = to[k]
                    break
                step[a] += 1
            else:
                if a == s:
                    break
                k = path.pop()
                a = to[k ^ 1]
                step[a] += 1


def label(page: Page, weights: np.ndarray) -> list[bool]:
    """Whether each block is content, by the cheapest cut."""
    x = features(page)
    score = x @ weights
    # What stands in an element that is never the article is boilerplate whatever its text; names only count against it.
    never = x[:, 1] > 0
    score[never] = -SURE
    likely = ~never & (x[:, 2] == 0) & (x[:, 6] < 0.5)
    if likely.any() and not (score > 0).any():
        # A page of short texts alone: its own best block sets the scale.
        score[likely] += 0.5 - score[likely].max()
    if not (score > 0).any() or not (score < 0).any():
        return (score > 0).tolist()
    n, edges = len(score), []
    up, region = page.parent, page.region

    def nearness(i: int, j: int) -> float:
        a, b = page.at[i], page.at[j]
        if region[a] != region[b]:
            return NEAR[3]
        if up[a] == up[b]:
            return NEAR[0]
        return NEAR[1] if up[max(up[a], 0)] == up[max(up[b], 0)] else NEAR[2]

    last: dict[int, int] = {}
    for i in range(n):
        if i:
            edges.append((i - 1, i, nearness(i - 1, i)))
        before = last.get(up[page.at[i]])
        if before is not None and before < i - 1:
            edges.append((before, i, NEAR[1] / 2))  # siblings with others between them
        last[up[page.at[i]]] = i
    return max_flow_side(n, np.maximum(score, 0).tolist(), np.maximum(-score, 0).tolist(), edges)


def main_text(html: str | None, weights: np.ndarray = PRIOR) -> str:
    """The content blocks of a page, one a line."""
    if not html:
        return ""
    page = Page(html)
    if not page.texts:
        return ""
    return "\n".join(t for t, keep in zip(page.texts, label(page, weights), strict=True) if keep)


def fit(pages: DataFrame) -> np.ndarray:
    """Weights of the classifier from a bounded sample of pages that mark their article."""
    bound_batches(pages.sparkSession)
    ids = pages.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE_PAGES)
    # At most SAMPLE_PAGES rows of one number are broadcast.
    some = pages.select("page_id", "html").join(F.broadcast(ids), "page_id", "left_semi").select("html")

    def rows(batches):
        for pdf in batches:
            out = []
            for html in pdf["html"]:
                page = Page(html or "")
                x = features(page)
                if len(x) and x[:, 3].any():  # it has an article
                    out += x[:: 1 + len(x) // SAMPLE_BLOCKS].tolist()
            yield pd.DataFrame({"x": pd.Series(out, dtype=object)})

    found = some.mapInPandas(tidy(rows), "x array<double>").collect()
    if not found:
        return PRIOR
    x = np.array(sorted(tuple(r["x"]) for r in found))
    y = ((x[:, 3] > 0) & (x[:, 1] == 0) & (x[:, 2] == 0)).astype(float)
    hidden = x.copy()
    hidden[:, STRUCTURE] = 0
    x, y = np.vstack([x, hidden]), np.concatenate([y, y])
    # The prior counts as evidence, so that what a sample doesn't tell stays as it is.
    w = PRIOR.copy()
    trust = 0.02 * len(x)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + trust * (w - PRIOR)
        hess = (x * np.maximum(p * (1 - p), 1e-4)[:, None]).T @ x + trust * np.eye(len(w))
        w = w - np.linalg.solve(hess, grad)
    return w


def text_of(html: Column, weights: np.ndarray) -> Column:
    """The main text of a column of pages."""
    bound_batches()

    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            for pages in batches:
                yield pd.Series([main_text(h, weights) for h in pages], dtype=object)
        finally:
            give_back()

    return extracted(html)


def extract(pages: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """The pages with ``text`` and ``n_chars``, its code points."""
    told = pages.withColumn("text", text_of(F.col("html"), fit(pages) if weights is None else weights))
    return told.withColumn("n_chars", F.length("text").cast("bigint"))
