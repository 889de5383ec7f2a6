"""Main text of web pages with a graphical model on the DOM tree.

Every block element and every block of text is a node with a hidden label, content or not; an element is
content if any text below it is. Node potentials come from tag, class and id words and from shape (length,
links, punctuation); parent-child potentials say how labels go together. Sum-product messages run from the
leaves up and from the root down, and blocks of text whose marginal is above one half are the main text.

The model is trained by the likelihood of labelled pages. These are built from a bounded sample of the given
pages (`LABELLED`): their article paragraphs and their other texts are set into many page layouts, in
semantic markup and in plain `div`s, so that the label of every block is known.
"""

from __future__ import annotations

import html
import math
import random
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABELLED = 240  # labelled pages; the bound of the training sample
LABELLED_CHARS = 50_000  # longest page taken for it
EPOCHS = 60
SEED = 6

_words = lambda s: frozenset(s.split())
INLINE = _words("a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr label img")
VOID = _words("area base br col embed hr img input link meta param source track wbr")
RAW = _words("script style textarea title xmp iframe noembed noframes")  # text up to their own end tag
UNSEEN = RAW | _words("head template noscript svg math select option optgroup button canvas object audio video datalist meter progress")
# Tags that end an open element of the same kind: opened tag -> tags it closes up to a boundary.
CLOSES = {
    "li": _words("li"), "dt": _words("dt dd"), "dd": _words("dt dd"), "tr": _words("tr td th"), "td": _words("td th"), "th": _words("td th"),
    "option": _words("option"), "thead": _words("tr td th"), "tbody": _words("thead tr td th"), "tfoot": _words("tbody tr td th"), "body": _words("head"),
}
BOUNDARY = _words("ul ol dl table select")

OTHER_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?", re.S)
NAME_END = re.compile(r"[\s/>]")
ATTRIBUTE = re.compile(r"(?<![^\s=/\"'>])([^\s=/\"'>]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.S)
LONG_NUMBER = re.compile(r"&#([0-9]{8,});?")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Node:
    parent: int
    tag: str
    tokens: list[str]
    text: str | None = None  # of a block of text
    label: str | None = None


@dataclass
class Tree:
    nodes: list[Node] = field(default_factory=list)


def _unescape(text: str) -> str:
    """Character references decoded; decimal ones of any length, of which the standard library takes 4,300 digits."""

    def short(m: re.Match) -> str:
        digits = m[1].lstrip("0") or "0"
        return f"&#{digits};" if len(digits) < 8 else "\N{REPLACEMENT CHARACTER}"

    return html.unescape(LONG_NUMBER.sub(short, text))


def _tag_ends(page: str) -> tuple[list[int], list[int]]:
    """Places of `>` and quotes, and for each the `>` that ends a tag whose attributes go on from there, -1 if none does."""
    marks = [m.start() for m in re.finditer("[>\"']", page)]
    ends = [-1] * (len(marks) + 1)
    following = {}  # quote -> the next mark of that kind
    for k in range(len(marks) - 1, -1, -1):
        mark = page[marks[k]]
        if mark == ">":
            ends[k] = marks[k]
        else:
            ends[k] = ends[following[mark] + 1] if mark in following else -1
            following[mark] = k
    return marks, ends


def _tokens(page: str) -> Iterator[tuple[int, int, str, str] | None]:
    """Tags as (start, end, name, attributes), names of end tags with the slash; comments and declarations have no name.
    Every character is looked at a bounded number of times. A sent place is where to go on."""
    marks, ends = _tag_ends(page)
    at, name_end = 0, -1
    while (start := page.find("<", at)) >= 0:
        at = start + 1
        if page.startswith(("!", "?"), at):
            at = OTHER_TOKEN.match(page, start).end()
            yield start, at, "", ""
            continue
        slash = page.startswith("/", at)
        name = at + slash
        if not (page[name : name + 1].isascii() and page[name : name + 1].isalpha()):
            continue
        if name_end < name:
            found = NAME_END.search(page, name)
            name_end = found.start() if found else len(page)
        end = ends[bisect_left(marks, name_end)]
        if end < 0:
            continue
        at = end + 1
        at = (yield start, at, page[start + 1 : name_end].lower(), page[name_end:end]) or at


def _name_tokens(attributes: str) -> tuple[list[str], str | None]:
    tokens, label = [], None
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id", "role", "itemprop", "aria-label"):
            tokens += [f"name={p.lower().rstrip('s')}" for p in NAME_PART.findall(_unescape(value))]
        elif name == "data-label":
            label = value
    if re.search(r"(?:^|\s)hidden(?:\s|=|$)|display:\s*none", attributes):
        tokens.append("hidden")
    return tokens, label


def parse(page: str) -> Tree:
    """The tree of block elements and blocks of text. Inline markup and line breaks stay inside a block;
    unclosed elements are closed as browsers do, stray end tags are ignored."""
    tree = Tree()
    nodes = tree.nodes
    nodes.append(Node(-1, "#root", []))
    stack = [(0, "#root")]
    opened: dict[str, list[int]] = defaultdict(list)  # tag -> its depths on the stack
    bounds = [0]  # depths of the boundaries
    parts: list[str] = []
    linked = 0
    links = 0
    unseen = 0
    link_depth = 0

    def flush() -> None:
        nonlocal parts, linked, links
        if parts:
            text = " ".join(_unescape("".join(parts)).split())
            if text:
                nodes.append(Node(stack[-1][0], "#text", _shape(text, linked, links, stack[-1][1]), text))
        parts, linked, links = [], 0, 0

    def read(raw: str) -> None:
        nonlocal linked
        if raw and not unseen:
            parts.append(raw)
            if link_depth:
                linked += len(raw)

    def pop() -> None:
        nonlocal unseen
        tag = stack.pop()[1]
        opened[tag].pop()
        if tag in UNSEEN:
            unseen -= 1
        if tag in BOUNDARY:
            bounds.pop()

    at = 0
    tokens = _tokens(page)
    token = next(tokens, None)
    while token:
        start, end, tag, attributes = token
        read(page[at:start])
        at = end
        closing = tag.startswith("/")
        tag = tag[closing:]
        goto = None
        if tag in INLINE:
            if tag == "a":
                link_depth = 0 if closing else 1
                links += not closing
            if tag == "br":
                parts.append(" ")
        elif closing:
            flush()
            link_depth = 0
            if opened[tag]:
                depth = opened[tag][-1]
                while len(stack) > depth:
                    pop()
        elif tag:
            flush()
            link_depth = 0
            while len(stack) > 1 and stack[-1][1] in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
                pop()
            shut = [opened[t][k] for t in CLOSES.get(tag, ()) if (k := bisect_right(opened[t], bounds[-1])) < len(opened[t])]
            while shut and len(stack) > min(shut):
                pop()
            names, label = _name_tokens(attributes) if attributes else ([], None)
            nodes.append(Node(stack[-1][0], tag, [f"tag={tag}", *names], label=label))
            if not (tag in VOID or attributes.rstrip().endswith("/") and tag not in RAW):
                opened[tag].append(len(stack))
                if tag in BOUNDARY:
                    bounds.append(len(stack))
                stack.append((len(nodes) - 1, tag))
                unseen += tag in UNSEEN
                if tag in RAW:
                    last = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
                    goto = at = last.start() if last else len(page)
        token = _next(tokens, goto)
    read(page[at:])
    flush()
    return tree


def _next(tokens: Iterator, goto: int | None):
    try:
        return tokens.send(goto)
    except StopIteration:
        return None


def _shape(text: str, linked: int, links: int, tag: str) -> list[str]:
    n = text.count(" ") + 1
    share = min(1.0, linked / max(1, len(text)))
    return [
        f"in={tag}", f"words={min(6, int(math.log2(n)))}", f"linked={int(share * 3)}", f"links={min(3, links)}", "ends=" + ("stop" if text[-1] in ".!?…\"”'" else "open"),
        "sign=" + ("mark" if text[0] in "©®™" or "©" in text[:40] else "none"), "one=text",
    ]


@dataclass
class Model:
    weights: dict[str, float]
    together: list[list[float]]  # log potential of (parent, child) labels

    def unary(self, node: Node) -> float:
        return sum(self.weights.get(t, 0.0) for t in node.tokens)


def _log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a)) if b - a > -50 else a


def marginals(parents: list[int], unary: list[float], together: list[list[float]]) -> list[float]:
    """P(content) of every node by sum-product; parents come before their children, the first is the root."""
    n = len(parents)
    (p00, p01), (p10, p11) = together
    up0, up1 = [0.0] * n, list(unary)  # potentials with the messages of the children
    to0, to1 = [0.0] * n, [0.0] * n
    for i in range(n - 1, 0, -1):
        a, b = up0[i], up1[i]
        m0, m1 = _log_add(p00 + a, p01 + b), _log_add(p10 + a, p11 + b)
        scale = max(m0, m1)
        to0[i], to1[i] = m0 - scale, m1 - scale
        up0[parents[i]] += to0[i]
        up1[parents[i]] += to1[i]
    all0, all1 = list(up0), list(up1)
    for i in range(1, n):
        q = parents[i]
        a, b = all0[q] - to0[i], all1[q] - to1[i]  # the parent without this child
        m0, m1 = _log_add(p00 + a, p10 + b), _log_add(p01 + a, p11 + b)
        scale = max(m0, m1)
        all0[i], all1[i] = up0[i] + m0 - scale, up1[i] + m1 - scale
    return [1 / (1 + math.exp(min(700.0, max(-700.0, x - y)))) for x, y in zip(all0, all1)]


def main_text(page: str | None, model: Model) -> str:
    """The text of the page's content blocks in page order, one line each; empty for null or empty pages."""
    if not page:
        return ""
    nodes = parse(page).nodes
    content = marginals([n.parent for n in nodes], [model.unary(n) for n in nodes], model.together)
    return "\n".join(n.text for n, p in zip(nodes, content) if n.text is not None and p > 0.5)


# --- labelled pages and training -------------------------------------------------------

# Names page authors commonly give to parts of a page.
CONTENT_NAMES = "article post content main entry story post-content entry-content article-body main-content text blog-post".split()
OTHER_NAMES = {
    "menu": "nav menu navbar navigation breadcrumbs topbar main-menu site-nav pagination tabs skip-links toc".split(),
    "header": "header masthead site-header page-header banner logo branding top-bar".split(),
    "footer": "footer site-footer page-footer bottom copyright legal colophon credits".split(),
    "sidebar": "sidebar aside widget related recommended side-column trending popular archive tags share social sharing".split(),
    "notice": "notice cookie cookie-banner consent alert popup modal overlay gdpr message disclaimer paywall subscribe-notice".split(),
    "advert": "ad ads advert advertisement sponsored sponsor promo promotion adsbygoogle ad-slot banner-ad".split(),
    "form": "form login signup newsletter search search-box subscribe contact-form register".split(),
    "comments": "comments comment comment-list comment-body reply replies discussion responses user-comments disqus reviews".split(),
}
_TAGS = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form", "notice": "dialog"}


def _strings(page: str) -> tuple[list[str], list[str]]:
    """Texts of a page inside and outside its article element."""
    nodes = parse(page).nodes
    inside = [False] * len(nodes)
    for i, n in enumerate(nodes[1:], 1):
        inside[i] = inside[n.parent] or n.tag == "article"
    texts = [(inside[i], n.text) for i, n in enumerate(nodes) if n.text]
    return [t for y, t in texts if y], [t for y, t in texts if not y]


def labelled_page(rng: random.Random, content: list[str], other: list[str]) -> str:
    """One page whose content blocks carry data-label="1"; all other text is not content."""
    esc = html.escape
    short = lambda: esc(" ".join(rng.choice(other).split()[: rng.randint(1, 6)]))
    long_ = lambda: esc(rng.choice(content if rng.random() < 0.5 else other))

    def named(kind: str, inner: str) -> str:
        name = rng.choice(OTHER_NAMES[kind])
        semantic = kind in _TAGS and rng.random() < 0.5
        tag = _TAGS[kind] if semantic else rng.choice(["div", "div", "section", "ul" if kind == "menu" else "div"])
        marked = "" if semantic and rng.random() < 0.6 else f' {rng.choice(["class", "class", "id"])}="{name}"'
        return f"<{tag}{marked}>{inner}</{tag}>"

    def other_part(kind: str) -> str:
        if kind == "menu":
            return named(kind, "".join(f'<li><a href="#">{short()}</a></li>' for _ in range(rng.randint(2, 8))))
        if kind == "header":
            return named(kind, f"<h1>{short()}</h1>" if rng.random() < 0.4 else f'<p>{short()}</p><a href="/">{short()}</a>')
        if kind == "footer":
            return named(kind, f"&copy; {short()} &middot; {long_()}" if rng.random() < 0.6 else f"<p>{long_()}</p>")
        if kind == "sidebar":
            return named(kind, f"<h3>{short()}</h3>" + "".join(f'<p>{long_()}</p>' if rng.random() < 0.4 else f'<li><a href="#">{short()}</a></li>' for _ in range(rng.randint(1, 5))))
        if kind == "form":
            return named(kind, f"<p>{short()}</p><label>{short()}</label><input type='text'><p>{long_()}</p><button>{short()}</button>")
        if kind == "comments":
            one = lambda: rng.choice([f'<div class="{rng.choice(OTHER_NAMES[kind])}"><p>{long_()}</p></div>', f"<li><p>{long_()}</p></li>", f'<article class="comment"><p>{long_()}</p></article>'])
            return named(kind, (f"<h2>{short()}</h2>" if rng.random() < 0.5 else "") + "".join(one() for _ in range(rng.randint(1, 5))))
        return named(kind, rng.choice([long_(), f"<p>{long_()}</p>", f"<p>{short()}</p><p>{long_()}</p>"]))

    body = [f'<h1 data-label="1">{esc(rng.choice(content))[:80]}</h1>'] if rng.random() < 0.8 else []
    for _ in range(rng.randint(1, 9)):
        kind = rng.random()
        one = lambda: esc(rng.choice(content)) if rng.random() < 0.8 else short()
        if kind < 0.7:
            body.append(f'<p data-label="1">{one()}' + ("</p>" if rng.random() < 0.8 else ""))
        elif kind < 0.78:
            body.append(f'<h2 data-label="1">{short()}</h2>')
        elif kind < 0.86:
            body.append("<ul>" + "".join(f'<li data-label="1">{one()}</li>' for _ in range(rng.randint(1, 4))) + "</ul>")
        elif kind < 0.9:
            body.append(f'<blockquote data-label="1">{one()}</blockquote>')
        elif kind < 0.94:
            body.append(f'<table><tr><td data-label="1">{one()}</td><td data-label="1">{short()}</td></tr></table>')
        else:
            body.append(other_part(rng.choice(["advert", "sidebar", "notice", "form"])))
    style = rng.random()
    if style < 0.5:
        middle = "<article>" + "".join(body) + "</article>"
        if rng.random() < 0.3:
            middle = f"<main>{middle}</main>"
    elif style < 0.65:
        middle = "<main>" + "".join(body) + "</main>"
    else:
        middle = f'<{rng.choice(["div", "section"])} {rng.choice(["class", "id"])}="{rng.choice(CONTENT_NAMES)}">' + "".join(body) + "</div>"
    before = [other_part(k) for k in rng.sample(["menu", "header", "notice", "advert", "menu", "form"], rng.randint(1, 4))]
    after = [other_part(k) for k in rng.sample(["footer", "sidebar", "comments", "comments", "advert", "form", "menu"], rng.randint(1, 5))]
    return "<html><head><title>t</title></head><body>" + "".join(before) + middle + "".join(after) + "</body></html>"


def train(pages: list[str]) -> Model:
    """Fits the potentials to labelled pages built from the texts of `pages`, by gradient steps on the
    likelihood: features seen minus features expected under the marginals."""
    rng = random.Random(SEED)
    content, other = [], []
    for page in pages:
        a, b = _strings(page)
        content += a
        other += b
    content = content or ["The quick brown fox jumps over the lazy dog, and then it rests."]
    other = other or ["Home", "All rights reserved."]
    trees, labels = [], []
    for _ in range(LABELLED):
        nodes = parse(labelled_page(rng, content, other)).nodes
        y = [n.label == "1" for n in nodes]
        for i, n in enumerate(nodes):
            if n.text is not None:
                y[i] = y[n.parent]
            elif n.label != "1":
                y[i] = False
        for i in range(len(nodes) - 1, 0, -1):  # an element is content if anything below is
            y[nodes[i].parent] |= y[i]
        trees.append(nodes)
        labels.append(y)
    counts = np.ones((2, 2))
    for nodes, y in zip(trees, labels):
        for i in range(1, len(nodes)):
            counts[int(y[nodes[i].parent]), int(y[i])] += 1
    counts[0, 1] = 0.01
    together = np.log(counts / counts.sum(axis=1, keepdims=True)).tolist()
    names = {t: k for k, t in enumerate(sorted({t for nodes in trees for n in nodes for t in n.tokens}))}
    x = np.zeros((sum(map(len, trees)), len(names)))
    row = 0
    for nodes in trees:
        for n in nodes:
            for t in n.tokens:
                x[row, names[t]] = 1
            row += 1
    truth = np.concatenate([np.array(y, float) for y in labels])
    w, square = np.zeros(len(names)), np.full(len(names), 1e-8)
    for _ in range(EPOCHS):
        scores = x @ w
        expected, row = [], 0
        for nodes in trees:
            expected += marginals([n.parent for n in nodes], scores[row : row + len(nodes)].tolist(), together)
            row += len(nodes)
        slope = x.T @ (truth - np.array(expected)) - 0.3 * w
        square += slope**2
        w += 0.6 * slope / np.sqrt(square)
    return Model({t: float(w[k]) for t, k in names.items()}, together)


def sample(pages: DataFrame) -> list[str]:
    """At most LABELLED pages with an article and at most LABELLED_CHARS long, the first by a hash of id and
    length; only their ids are sorted."""
    fit = pages.where(f"page_id IS NOT NULL AND length(html) <= {LABELLED_CHARS} AND contains(html, '<article')")
    ids = [r.page_id for r in fit.select("page_id", F.xxhash64(F.lit(SEED), "page_id", F.length("html")).alias("k")).orderBy("k", "page_id").limit(LABELLED).collect()]
    rows = fit.where(F.col("page_id").isin(ids)).groupBy("page_id").agg(F.min("html").alias("html")).collect() if ids else []
    return [r.html for r in sorted(rows, key=lambda r: r.page_id)]


def extracted(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page; repeated rows each get their own result.

    Null and empty pages have empty text. Whole pages are read, whatever their length.
    """
    model = model or train(sample(pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                texts = [main_text(p.as_py(), model) for p in part.column(2)]
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
