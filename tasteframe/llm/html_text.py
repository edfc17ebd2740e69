"""Main text of web pages: a tree-structured graphical model over DOM nodes, content marginals by sum-product messages."""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteframe.llm.common import pieces

#: Elements by their role in HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q ruby rt rp s samp small span strike strong sub sup "
                   "time tt u var wbr input label picture source canvas audio video object iframe xmp noembed noframes "
                   "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder mover munderover "
                   "mmultiscripts mprescripts mtable mtr mtd maction semantics annotation".split())
#: Elements without reading text, up to their end tag; form controls, up to their end tag or the block that ends them.
RAW = frozenset("script style noscript template textarea title svg head".split())
CONTROLS = frozenset("button select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Opening one of these closes an open element of the given names.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
    "tbody": ("tr", "td", "th"), "thead": ("tr", "td", "th"), "tfoot": ("tr", "td", "th"),
}
NO_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
                 "menu nav ol p pre section table ul".split())
#: Where a search for an element to close stops.
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "tbody": ("table",), "thead": ("table",), "tfoot": ("table",)}

#: Words in class, id and role, by what they hint at.
HINTS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc pagination pager tabs topbar skip links",
    "header": "header masthead banner logo branding sitehead",
    "footer": "footer colophon copyright legal bottom imprint",
    "sidebar": "sidebar aside widget widgets related recommended recommendations rail share social sharing tags trending popular complementary",
    "notice": "cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription alert toast paywall privacy",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner adsense dfp",
    "comment": "comment comments reply replies respond discussion disqus commentlist feedback",
    "form": "form login signin signup search register contact",
    "content": "article content post entry main story body text prose page paragraph",
}
_BLOCK = "|".join(sorted(NO_P | set(CLOSES) - {"option"} | {"body", "html"}, key=len, reverse=True))
_END = {t: re.compile(rf"</{t}\b[^>]*+>?", re.I) for t in RAW} | {t: re.compile(rf"(</{t}\b[^>]*+>?)|<{t}\b|</?(?:{_BLOCK})\b", re.I) for t in CONTROLS}
_HINT_OF = {w: k for k, words in HINTS.items() for w in words.split()}

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>?")
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Node:
    parent: int
    tag: str
    hints: frozenset[str]
    chars: int = 0
    link_chars: int = 0
    ends: int = 0
    parts: list[str] = field(default_factory=list)


def parse(page: str | None) -> tuple[list[Node], list[tuple[int, str]]]:
    """(nodes in page order, text blocks in page order as (node, text)).

    Nodes are block elements; inline ones belong to the block they stand in. A block's text ends where another block begins
    or ends. Scripts, styles, heads, comments, form controls and other elements without reading text are left out, missing end tags are
    filled in, unmatched ones ignored. A control that is not closed ends where a block or the next control begins. The time is
    proportional to the page, however it is built. Character references are decoded, white space in a block becomes one space.
    """
    source = page or ""
    nodes = [Node(-1, "#root", frozenset())]
    blocks: list[tuple[int, str]] = []
    stack = [0]
    open_tags: Counter[str] = Counter()
    run: list[str] = []
    endless: set[str] = set()
    in_link = 0

    def flush() -> None:
        if run:
            text = "".join(run)
            words = " ".join((entities.unescape(text) if "&" in text else text).split())
            run.clear()
            if words:
                at = stack[-1]
                if at == 0:  # text that stands in no block is a node of its own
                    nodes.append(Node(0, "#text", frozenset(), link_chars=nodes[0].link_chars))
                    nodes[0].link_chars = 0
                    at = len(nodes) - 1
                node = nodes[at]
                node.chars += len(words)
                node.ends += sum(words.count(c) for c in ".!?;:")
                blocks.append((at, words))

    def close(name: str) -> None:
        while True:
            at = stack.pop()
            open_tags[nodes[at].tag] -= 1
            if nodes[at].tag == name:
                return

    def close_if(names: tuple[str, ...], scope: tuple[str, ...]) -> None:
        for name in names:
            if open_tags[name]:
                for at in reversed(stack):
                    if nodes[at].tag in scope:
                        break
                    if nodes[at].tag == name:
                        close(name)
                        break

    at, size = 0, len(source)
    while at < size:
        lt = source.find("<", at)
        if lt < 0:
            lt = size
        if lt > at:
            run.append(source[at:lt])
            if in_link:
                nodes[stack[-1]].link_chars += len(source[at:lt].strip())
            at = lt
            continue
        if source.startswith("<!--", at):
            end = source.find("-->", at + 4)
            at = size if end < 0 else end + 3
            continue
        if source.startswith(("<!", "<?"), at):
            end = source.find(">", at)
            at = size if end < 0 else end + 1
            continue
        m = _TAG.match(source, at)
        if not m:
            run.append("<")
            at += 1
            continue
        at = m.end()
        closing, tag, rest = m[1], m[2].lower(), m[3]
        if tag in _END and not closing:
            if not rest.endswith("/"):
                end = None if tag in endless else _END[tag].search(source, at)
                if end:
                    at = end.end() if tag in RAW or end[1] else end.start()
                else:
                    endless.add(tag)  # nor will a later one find an end
                    if tag in CONTROLS or tag in ("script", "style", "textarea", "title"):
                        at = size
            run.append(" ")
            continue
        if tag in INLINE or tag in _END:
            if tag == "a":
                in_link = 0 if closing else 1
            elif tag in ("br", "img", "input", "wbr"):
                run.append(" " if tag != "wbr" else "")
            continue
        flush()
        if closing:
            if tag not in ("html", "body") and open_tags[tag]:
                close(tag)
            continue
        if tag in VOID or tag in ("html", "body"):
            continue
        if tag in NO_P:
            close_if(("p",), ("article", "section", "div", "td", "th", "li", "main", "aside", "blockquote"))
        if tag in CLOSES:
            close_if(CLOSES[tag], SCOPE.get(tag, ()))
        words = (w for a in _ATTR.finditer(rest) for w in _WORD.findall((a[2] or a[3] or a[4] or "").lower()))
        nodes.append(Node(stack[-1], tag, frozenset(_HINT_OF[w] for w in words if w in _HINT_OF)))
        stack.append(len(nodes) - 1)
        open_tags[tag] += 1
    flush()
    return nodes, blocks


def features(nodes: list[Node]) -> list[list[str]]:
    """Per node: tag, hints, and bins of the share of link text, the length and the sentence ends of the text below it."""
    chars, links, ends = ([getattr(n, k) for n in nodes] for k in ("chars", "link_chars", "ends"))
    for i in range(len(nodes) - 1, 0, -1):
        p = nodes[i].parent
        chars[p] += chars[i]
        links[p] += links[i]
        ends[p] += ends[i]
    out = []
    for i, n in enumerate(nodes):
        share = min(1.0, links[i] / chars[i]) if chars[i] else 0.0
        out.append([
            f"tag:{n.tag}", *(f"hint:{h}" for h in sorted(n.hints)), f"links:{0 if share < 0.1 else 1 if share < 0.5 else 2}",
            f"chars:{min(4, int(math.log10(chars[i] + 1) * 1.5))}", f"ends:{min(2, ends[i])}",
        ])
    return out


#: The features that decide alone what their elements are; the rest count with a share, as they are far from independent.
STRONG, WEAK = ("tag:", "hint:"), 0.25


@dataclass(frozen=True)
class Model:
    """Log-odds of features, log-potentials of (parent, child) states and the prior of the root; states are 0 rest, 1 content."""

    weights: dict[str, float]
    pair: tuple[tuple[float, float], tuple[float, float]]
    root: float

    def unary(self, names: list[str]) -> float:
        return sum(self.weights.get(f, 0.0) * (1.0 if f.startswith(STRONG) else WEAK) for f in names)

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability of content of every node: messages from the leaves to the root, then back."""
        n = len(nodes)
        own = []
        for names in features(nodes):
            odds = max(-30.0, min(30.0, self.unary(names)))
            p = 1 / (1 + math.exp(-odds))
            own.append((1 - p, p))
        own[0] = (1 - self.root, self.root)
        (a, b), (c, d) = self.pair
        up = [(1.0, 1.0)] * n  # product of the messages of the children
        sent = [(1.0, 1.0)] * n  # message to the parent
        for i in range(n - 1, 0, -1):
            x, y = own[i][0] * up[i][0], own[i][1] * up[i][1]
            m0, m1 = a * x + b * y, c * x + d * y
            total = m0 + m1
            sent[i] = (m0 / total, m1 / total)
            p = nodes[i].parent
            u = (up[p][0] * sent[i][0], up[p][1] * sent[i][1])
            total = u[0] + u[1]
            up[p] = (u[0] / total, u[1] / total) if total > 0 else (0.5, 0.5)
        down = [(1.0, 1.0)] * n
        out = [0.0] * n
        for i in range(n):
            if i:
                p = nodes[i].parent
                # the parent without what this child told it
                x, y = (own[p][s] * down[p][s] * up[p][s] / max(sent[i][s], 1e-300) for s in (0, 1))
                d0, d1 = a * x + c * y, b * x + d * y
                total = d0 + d1
                down[i] = (d0 / total, d1 / total) if total > 0 else (0.5, 0.5)
            x, y = (own[i][s] * up[i][s] * down[i][s] for s in (0, 1))
            out[i] = y / (x + y) if x + y > 0 else 0.5
        return out

    def text(self, page: str | None) -> str:
        nodes, blocks = parse(page)
        if not blocks:
            return ""
        content = self.marginals(nodes)
        return "\n".join(text for node, text in blocks if content[node] >= 0.5)


#: Labelled layouts. Elements with data-main="1" (and all below, up to data-main="0") are content.
LAYOUTS = [
    '<header class="masthead"><a href="/">Site</a></header><nav class="menu"><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>'
    '<main data-main="1"><article><h1>Title of it.</h1><p>Some words stand here, as a sentence does. Another one follows it.</p><ul><li>First point.</li><li>Second '
    'point.</li></ul><blockquote><p>Quoted words of someone.</p></blockquote><aside class="related" data-main="0"><h3>Related</h3><ul><li><a href="/c">More to '
    'read</a></li></ul></aside></article></main><section class="comments"><h2>Comments</h2><div class="comment"><p>I liked this text a lot. Thanks.</p></div><form '
    'class="reply"><p>Leave a reply.</p></form></section><footer class="footer"><p>Copyright, all rights reserved.</p></footer>',
    '<div class="cookie consent"><p>We use cookies to make this site better. Accept them here.</p></div><div class="header"><div class="logo">Name</div></div><div class="content"'
    ' data-main="1"><h2>Heading</h2><p>A paragraph of text with some sentences. It goes on, and ends.</p><div class="ad" data-main="0">Buy this thing now. It is '
    'cheap.</div><p>The text goes on after the advert. It ends here.</p><table><tr><td>Cell one</td><td>Cell two</td></tr></table><div class="newsletter" data-main="0"><p>Subscribe '
    'to our letter.</p></div></div><div class="sidebar"><div class="widget"><h4>Popular</h4><ul><li><a href="/x">A popular thing</a></li></ul></div></div><div '
    'class="footer"><ul><li><a href="/i">Imprint</a></li></ul></div>',
    '<div class="topbar"><a href="/">Home</a></div><div class="post" data-main="1"><div class="entry"><p>The first words of a post, long enough to read. They go on.</p><pre>code of '
    'it</pre><dl><dt>Term</dt><dd>What it means.</dd></dl><figure><figcaption>What the picture shows.</figcaption></figure><ol><li>One step.</li><li>Another.</li></ol></div><div '
    'class="share social" data-main="0"><a href="/s">Share</a></div><div class="comments" data-main="0"><div class="comment"><p>A comment of a reader. It is short.</p></div></div></div><aside>'
    '<div class="promo"><p>A sponsored story. Read it.</p></div></aside><form class="search"><p>Search here</p></form><div class="advert"><p>An advert. It sells.</p></div>',
    '<main data-main="1"><section><h2>Part one.</h2><p>Words of the first part. They are plain.</p></section><section><h3>Part two.</h3><div>Words of the second part, in a plain box. '
    'More of them.</div></section><form data-main="0"><p>Sign up with your name.</p></form><nav class="pagination" data-main="0"><a href="/2">Next</a></nav><div class="notice" data-main="0"><p>This site '
    'will be down soon. Please wait.</p></div></main><aside class="sidebar"><p>About the author. A short text.</p></aside><footer><p>Contact us. Terms.</p></footer>',
]
_MARK = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
#: How often a layout counts, and the most corpus pages that are labelled by their own markup.
LAYOUT_WEIGHT, SAMPLE = 40, 500
#: Prior probability that the root is content: plain text without blocks is kept.
ROOT = 0.6
#: Weight of the corpus pages against the layouts, however many of them are labelled; one page counts once at most.
CORPUS_SHARE = 0.25
REST = frozenset("nav aside footer header form dialog menu".split())


def labelled_layout(layout: str) -> tuple[list[Node], list[int]]:
    """Nodes of a layout and their labels: those of the nearest data-main at or above them."""
    nodes, _ = parse(layout)
    marks = []
    for m in _MARK.finditer(layout):
        if not m[1] and m[2].lower() not in INLINE and m[2].lower() not in VOID:
            found = re.search(r'data-main="([01])"', m[3])
            marks.append(int(found[1]) if found else None)
    labels = [0]
    for node, mark in zip(nodes[1:], marks, strict=True):
        labels.append(labels[node.parent] if mark is None else mark)
    return nodes, labels


def labelled_page(page: str | None) -> tuple[list[Node], list[int]] | None:
    """Labels that the page's own markup gives: below its article or main, without elements and hints of the rest; None without one."""
    nodes, _ = parse(page)
    if not any(n.tag in ("article", "main") for n in nodes):
        return None
    labels = [0]
    for n in nodes[1:]:
        inside = labels[n.parent] == 1 or n.tag in ("article", "main") and not any(nodes[k].tag in REST for k in [n.parent])
        labels.append(int(inside and n.tag not in REST and not n.hints - {"content"}))
    return nodes, labels


def train(pages: DataFrame, sample: int = SAMPLE) -> Model:
    """Count features and parent-child states of labelled pages: the layouts, and at most ``sample`` pages that mark their article.

    The pages are those with the smallest hash of page_id and html, equal ones once; counts of their features are summed in Spark. Eager.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            seen: Counter[tuple[str, int]] = Counter()
            for page in b.column(0).to_pylist():
                made = labelled_page(page)
                if made:
                    seen.update(_counts(*made))
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in seen]), pa.array([y for _, y in seen], pa.int32()), pa.array(seen.values(), pa.int64())], ["name", "label", "n"])

    few = pages.select(F.col("html").cast("string").alias("html"), F.xxhash64("page_id", "html").alias("h")).filter("html is not null")
    # hashes first: whole pages of a few hundred are read again, and not sent to one task
    last = few.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    few = few.filter(F.lit(False) if last is None else F.col("h") <= last).groupBy("h").agg(F.first("html").alias("html")).select("html")
    total: Counter[tuple[str, int]] = Counter()
    for r in few.mapInArrow(run, "name string, label int, n long").groupBy("name", "label").agg(F.sum("n").alias("n")).collect():
        total[r.name, r.label] += r.n
    pages_seen = max(1, total.get(("page", 1), 0))
    scale = min(1.0, LAYOUT_WEIGHT * len(LAYOUTS) * CORPUS_SHARE / pages_seen)
    counts = {k: v * scale for k, v in total.items()}
    for layout in LAYOUTS:
        for k, v in _counts(*labelled_layout(layout)).items():
            counts[k] = counts.get(k, 0) + LAYOUT_WEIGHT * v
    rest, content = counts.get(("node", 0), 0) + 1, counts.get(("node", 1), 0) + 1
    names = {n for n, _ in counts if ":" in n and not n.startswith("pair:")}
    weights = {n: math.log((counts.get((n, 1), 0) + 0.5) / content) - math.log((counts.get((n, 0), 0) + 0.5) / rest) for n in names}
    pair = []
    for p in (0, 1):
        both = [counts.get((f"pair:{p}", y), 0) + 1 for y in (0, 1)]
        pair.append(tuple(x / sum(both) for x in both))
    return Model(weights, tuple(pair), ROOT)


def _counts(nodes: list[Node], labels: list[int]) -> Counter:
    seen: Counter[tuple[str, int]] = Counter({("page", 1): 1})
    for names, n, y in list(zip(features(nodes), nodes, labels, strict=True))[1:]:
        seen.update((f, y) for f in names)
        seen["node", y] += 1
        seen[f"pair:{labels[n.parent]}", y] += 1
    return seen


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """(page_id, url, text, n_chars), a row per row: the blocks whose content marginal is 0.5 or more, joined by a line break.

    Null html counts as empty, pages without content have an empty text. Whole pages are read. Ids may be null or repeat; other
    columns are ignored. Without ``model`` one is trained on ``pages`` (eager).
    """
    model = model or train(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            texts = [model.text(page) for page in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
