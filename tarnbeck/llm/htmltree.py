"""Main text of web pages by a tree-structured graphical model.

Each block of the DOM, and each run of text in one, is a binary variable: content or not. Node potentials are linear in
features of tag, names and text; a potential on each parent-child edge couples a node with its parent, and it too
depends on the child's kind. Messages pass from the leaves up and from the root down (sum-product), which gives every
node's marginal exactly; text whose marginal reaches one half is kept. The weights are those of a conditional random
field, trained by gradient steps on labelled pages that are made from a rule: layouts of many kinds around an article.
"""

from __future__ import annotations

import functools
import html as html_
import math
import random
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnbeck.llm.common import in_batches, table

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)\]\]>|<[!?][^>]*>|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)[^>]*>""", re.S)
_ATTR = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden|aria-label)\b\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORDS = re.compile(r"[a-z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Content of these is no text of the page.
RAW = frozenset("script style noscript template title textarea iframe svg math object select datalist canvas audio video head".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "thead": {"tbody"}, "tfoot": {"tbody", "tr", "td", "th"}}
FENCE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "tbody": {"table"}, "thead": {"table"}, "tfoot": {"table"}, "option": {"select"}}
GROUPS = {
    "nav": "nav menu", "header": "header", "footer": "footer", "aside": "aside", "form": "form button input label fieldset legend option output dialog", "article": "article", "main": "main", "section": "section", "div": "div center", "p": "p",
    "heading": "h1 h2 h3 h4 h5 h6 hgroup", "list": "ul ol dl dir", "item": "li dt dd", "table": "table tbody thead tfoot tr td th caption", "quote": "blockquote pre address", "figure": "figure figcaption details summary", "body": "html body",
}
_GROUP = {tag: g for g, tags in GROUPS.items() for tag in tags.split()}
NAMES = {
    "n_menu": "nav navbar navigation menu breadcrumb breadcrumbs toc pagination pager tabs topnav skip", "n_ad": "ad ads advert advertisement advertising sponsor sponsored promo promotion banner adslot adsense dfp", "n_foot": "footer foot copyright legal colophon bottom contentinfo",
    "n_side": "sidebar side aside widget related recommended recommend trending popular rail complementary more", "n_notice": "cookie cookies notice consent gdpr newsletter subscribe subscription popup modal alert overlay paywall message toast warning disclaimer signup login", "n_comment": "comment comments disqus reply replies discussion respond commentlist feedback reviews",
    "n_share": "share sharing social follow tags meta byline author rating vote toolbar tools", "n_head": "header masthead head top logo brand search site", "n_form": "form search input field login", "n_hidden": "hidden none invisible offscreen",
    "n_content": "content article post entry main story text body page prose document blog news single",
}
_NAME = {w: g for g, words in NAMES.items() for w in words.split()}


class Page:
    """Nodes in page order, so a parent stands before its children: parent, features, own text."""

    def __init__(self) -> None:
        self.parent: list[int] = []
        self.group: list[str] = []
        self.names: list[frozenset[str]] = []
        self.text: list[str | None] = []
        self.links: list[int] = []
        self.mark: list[str | None] = []

    def add(self, parent: int, group: str, names: frozenset[str], text: str | None = None, links: int = 0, mark: str | None = None) -> int:
        for column, value in ((self.parent, parent), (self.group, group), (self.names, names), (self.text, text), (self.links, links), (self.mark, mark)):
            column.append(value)
        return len(self.parent) - 1


_NONE: frozenset[str] = frozenset()


def _names(attrs: str) -> tuple[frozenset[str], str | None]:
    found, mark = set(), None
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            found.add("n_hidden")
        elif key in ("class", "id", "role", "aria-label"):
            found.update(_NAME[w] for w in _WORDS.findall(value) if w in _NAME)
            if key == "id" and value.startswith("label-"):
                mark = value[6:]
    return frozenset(found), mark


def parse(html: str | None) -> Page:
    """The page's blocks. Void, raw and unclosed elements, implied ends and stray ends are dealt with; depth is unbounded, as nothing recurs."""
    page = Page()
    page.add(-1, "body", _NONE)
    stack: list[tuple[str, int]] = []  # open elements, and the block that each is or stands in
    block, buffer, links, deep, held = 0, [], 0, 0, False
    html = html or ""
    at = 0
    unescape = html_.unescape

    def flush() -> None:
        nonlocal buffer, links, held
        if held:
            text = " ".join("".join(buffer).split())
            if text:
                page.add(block, "text", _NONE, text, min(links, len(text)))
        buffer, links, held = [], 0, False

    def take(piece: str) -> None:
        nonlocal links, held
        if "&" in piece:
            piece = unescape(piece)
        buffer.append(piece)
        held = True
        if deep:
            links += len(piece)

    def pop_to(k: int) -> None:
        nonlocal block, deep
        flush()
        for tag, _ in stack[k:]:
            deep -= tag == "a"
        del stack[k:]
        block = stack[-1][1] if stack else 0

    while m := _TOKEN.search(html, at):
        if m.start() > at:
            take(html[at : m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            if m["data"] is not None:
                take(m["data"])
            continue
        tag = tag.lower()
        if m["close"] or m["close2"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    if tag in INLINE and all(t in INLINE for t, _ in stack[k:]):
                        if stack[k][1] != (stack[k - 1][1] if k else 0):
                            pop_to(k)
                        else:
                            deep -= tag == "a"
                            del stack[k]
                    else:
                        pop_to(k)
                    break
                if tag in INLINE and stack[k][0] not in INLINE or tag not in INLINE and tag != "body" and stack[k][0] in ("article", "main", "td", "body") and tag in ("p", "b", "li", "span"):
                    break
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at) if not (m["attrs"] or "").endswith("/") or tag in ("script", "style", "title") else None
            if tag not in ("svg", "math") or end:
                at = end.end() if end else (len(html) if tag in ("script", "style", "textarea", "title") else at)
            if tag not in INLINE:
                flush()
            continue
        if tag in ("br", "hr"):
            flush()
            continue
        if tag in VOID:
            continue
        attrs = m["attrs"] or ""
        names, mark = _names(attrs) if attrs.strip(" /") else (_NONE, None)
        if tag in INLINE:
            own = block
            if names - {"n_content", "n_head"} and tag != "a" or "n_ad" in names or "n_share" in names:
                flush()
                own = block = page.add(block, "inline", names, mark=mark)
            if not attrs.endswith("/"):
                stack.append((tag, own))
                deep += tag == "a"
            continue
        flush()
        if tag in CLOSES_P:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    pop_to(k)
                    break
                if stack[k][0] not in INLINE:
                    break
        if tag in SAME:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in SAME[tag]:
                    pop_to(k)
                    if tag not in ("tr", "tbody", "tfoot"):
                        break
                elif stack[k][0] in FENCE.get(tag, ()):
                    break
        # what inline elements a block stands in count no more: their ends come or not
        block = stack[-1][1] if stack else 0
        block = page.add(block, _GROUP.get(tag, "other"), names, mark=mark)
        stack.append((tag, block))
    if at < len(html):
        rest = html[at:]
        take(rest if not re.match(r"<[a-zA-Z/!]", rest) else "")
    flush()
    return page


#: Kinds of child that an edge potential tells apart.
_EDGE = {"text": "text", "inline": "part", "p": "part", "heading": "part", "item": "part", "list": "part", "table": "part", "quote": "part", "figure": "part"}


def features(page: Page) -> list[list[str]]:
    n = len(page.parent)
    size, link, main = [0] * n, [0] * n, [False] * n
    for i in range(n - 1, 0, -1):
        if page.text[i] is not None:
            size[i], link[i] = len(page.text[i]), page.links[i]
        p = page.parent[i]
        size[p] += size[i]
        link[p] += link[i]
    out = []
    for i in range(n):
        p = page.parent[i]
        main[i] = page.group[i] in ("article", "main") or p >= 0 and main[p]
        g = page.group[i]
        f = ["bias", f"g_{g}"]
        inside = "in_main" if p >= 0 and main[p] else "out"
        if g in ("header", "footer", "div", "section", "form", "aside"):
            f.append(f"{g}_{inside}")
        if g == "text":
            f.append(f"text_{inside}_{min(len(page.text[i]) // 25, 3)}")
            if page.text[i][-1] in ".!?":
                f.append("stop")
        for name in page.names[i]:
            f.append(name)
            f.append(f"{name}_{inside}")
        if size[i] and g != "body":
            dense = link[i] / size[i]
            f.append("dense" if dense > 0.6 else "mixed" if dense > 0.2 else "plain")
            if dense > 0.6 and g in ("list", "text", "item", "p"):
                f.append(f"dense_{inside}")
        out.append(f)
    return out


def marginals(page: Page, feats: list[list[str]], w: dict[str, float]) -> tuple[list[float], list[tuple[float, ...]]]:
    """Each node's probability of content, and of each edge the joint probabilities (00, 01, 10, 11) of parent and child.

    Up: a node gathers its children's messages and sends its own; down: it takes its parent's belief without that
    message. All in log-odds, one pass each.
    """
    n = len(page.parent)
    get = w.get
    own = [sum(get(x, 0.0) for x in f) for f in feats]
    exp, log1p = math.exp, math.log1p

    def soft(a: float, b: float) -> float:
        return a + log1p(exp(b - a)) if a >= b else b + log1p(exp(a - b))

    up, sent = own[:], [0.0] * n
    edge: list[tuple[float, float, float]] = [(0.0, 0.0, 0.0)] * n
    for i in range(n - 1, 0, -1):
        kind = _EDGE.get(page.group[i], "block")
        e01, e10, e11 = edge[i] = (get(f"e01_{kind}", 0.0), get(f"e10_{kind}", 0.0), get(f"e11_{kind}", 0.0))
        sent[i] = soft(e10, e11 + up[i]) - soft(0.0, e01 + up[i])
        up[page.parent[i]] += sent[i]
    belief, joint = up[:], [(0.0, 0.0, 0.0, 0.0)] * n
    for i in range(1, n):
        rest = belief[page.parent[i]] - sent[i]
        e01, e10, e11 = edge[i]
        a, b, c, d = 0.0, e01 + up[i], e10 + rest, e11 + rest + up[i]
        belief[i] = up[i] + soft(e01, e11 + rest) - soft(0.0, e10 + rest)
        top = max(a, b, c, d)
        z = [exp(v - top) for v in (a, b, c, d)]
        s = sum(z)
        joint[i] = (z[0] / s, z[1] / s, z[2] / s, z[3] / s)
    return [1 / (1 + exp(-max(-700.0, min(700.0, b)))) for b in belief], joint


def train(pages: list[tuple[Page, list[int]]], rounds: int = 14, rate: float = 0.15) -> dict[str, float]:
    """Gradient steps on the conditional likelihood: features and edges as labelled less as expected; adaptive rates, small decay."""
    w: dict[str, float] = {}
    seen: dict[str, float] = {}
    order = random.Random(3)
    ready = [(p, features(p), y) for p, y in pages]
    for _ in range(rounds):
        order.shuffle(ready)
        for page, feats, y in ready:
            p, joint = marginals(page, feats, w)
            g: dict[str, float] = {}
            for i, f in enumerate(feats):
                d = y[i] - p[i]
                for x in f:
                    g[x] = g.get(x, 0.0) + d
            for i in range(1, len(y)):
                kind = _EDGE.get(page.group[i], "block")
                at = 2 * y[page.parent[i]] + y[i]
                for k, name in ((1, "e01"), (2, "e10"), (3, "e11")):
                    key = f"{name}_{kind}"
                    g[key] = g.get(key, 0.0) + (at == k) - joint[i][k]
            for x, d in g.items():
                d -= 0.002 * w.get(x, 0.0)
                seen[x] = seen.get(x, 0.01) + d * d
                w[x] = w.get(x, 0.0) + rate * d / math.sqrt(seen[x]) * 2
    return w


def labelled(n: int = 400, seed: int = 5) -> list[tuple[Page, list[int]]]:
    """Pages made from a rule, with labels: elements that the id "label-0" marks are no content, nor is what they hold."""
    r = random.Random(seed)
    pick, some = r.choice, r.randint
    word = lambda: "".join(pick(("th", "er", "on", "an", "re", "la", "de", "st", "é", "ü", "ti", "en")) for _ in range(some(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(some(a, b)))
    sentence = lambda a=3, b=30: words(a, b).capitalize() + pick(".....!?")
    link = lambda: f'<a href="/{word()}">{words(1, 3)}</a>'
    off = lambda tag, cls, inner: f'<{tag} id="label-0"{f" class={chr(34)}{cls}{chr(34)}" if cls else ""}>{inner}</{tag}>'
    links = lambda: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(some(2, 8))) + "</ul>"

    def boiler() -> str:
        return pick((
            lambda: off("nav", pick(("", "menu", "navbar", "breadcrumb")), links()), lambda: off("div", pick(("menu", "nav", "breadcrumbs", "pagination")), links()), lambda: off("aside", pick(("", "sidebar", "related")), f"<h3>{words(1, 3)}</h3>" + pick((links(), f"<p>{sentence()}</p>"))),
            lambda: off("div", pick(("sidebar", "widget", "related posts", "trending")), f"<h4>{words(1, 2)}</h4>" + pick((links(), f"<p>{sentence()}</p>"))), lambda: off("div", pick(("ad", "ads", "advert", "sponsored", "promo banner", "ad-slot")), pick((sentence(), f"<p>{sentence()} {link()}</p>"))),
            lambda: off(pick(("div", "section")), pick(("cookie-notice", "notice", "newsletter", "consent", "alert", "subscribe")), pick((sentence(), f"<p>{sentence(5, 40)}</p><button>{word()}</button>"))), lambda: off("form", pick(("", "search", "login")), f"<label>{words(1, 2)}</label><input name=q><button>{word()}</button>"),
            lambda: off(pick(("section", "div", "ol")), pick(("comments", "comment-list", "disqus comments", "replies")), f"<h3>{words(1, 2)}</h3>" * some(0, 1) + "".join(f'<div class="comment"><p>{word()}</p><p>{sentence(3, 40)}</p></div>' for _ in range(some(1, 4)))), lambda: off("div", pick(("share", "social", "share-buttons", "byline meta")), " ".join(link() for _ in range(some(2, 4)))),
        ))()

    def body() -> str:
        return pick((
            lambda: f"<p>{' '.join(sentence() for _ in range(some(1, 6)))}</p>", lambda: f"<p>{sentence(1, 4)}</p>", lambda: f"<p><b>{sentence()}<br><p>{sentence()}</p>", lambda: f"<p>{sentence()} {link()} {sentence()}</p>", lambda: f"<h2>{words(1, 6)}</h2>", lambda: "<ul>" + "".join(f"<li>{sentence(1, 9)}</li>" for _ in range(some(2, 5))) + "</ul>",
            lambda: f"<blockquote><p>{sentence()}</p></blockquote>", lambda: f"<pre>{words(2, 9)}</pre>", lambda: f"<table><tr><th>{word()}</th><td>{word()}</td></tr><tr><td>{words(1, 3)}</td><td>{word()}</td></tr></table>", lambda: f"<figure><img src=x><figcaption>{sentence()}</figcaption></figure>", lambda: f"<div>{sentence()}</div>", lambda: f"<section><h3>{words(1, 4)}</h3><p>{sentence()}</p></section>",
            lambda: f'<p>{sentence()} <em>{words(1, 3)}</em> <span class="x">{word()}</span> {sentence()}</p>', lambda: f"{sentence()}<br>{sentence()}",
        ))()

    made = []
    for _ in range(n):
        parts = [f"<h1>{words(2, 9)}</h1>"] + [body() for _ in range(some(1, 14))]
        if r.random() < 0.15:
            parts[0] = f"<header>{parts[0]}</header>"
        for _ in range(pick((0, 0, 1, 2))):
            parts.insert(some(1, len(parts)), boiler())
        inner = "".join(parts)
        kind = r.random()
        if kind < 0.4:
            inner = f"<article>{inner}</article>"
        elif kind < 0.55:
            inner = f"<main>{inner}</main>"
        elif kind < 0.65:
            inner = f"<main><article>{inner}</article></main>"
        elif kind < 0.95:
            inner = f'<{pick(("div", "section"))} class="{pick(("content", "post", "entry-content", "article-body", "story", "main", "page text", "col", "wrap"))}">{inner}</div></section>'
        before = [off("header", pick(("", "site-header", "masthead")), pick((f"<h1>{words(1, 2)}</h1>", links(), f"<div>{words(1, 4)}</div>" + links())))] * some(0, 1) + [off("nav", "", links())] * some(0, 1) + [boiler() for _ in range(some(0, 3))]
        after = [boiler() for _ in range(some(0, 3))] + [off(*pick((("footer", ""), ("footer", ""), ("footer", "footer"), ("footer", "site bottom"), ("div", "footer"), ("div", "copyright footer"))), pick((f"&copy; {words(1, 3)} &middot; {sentence()}", links(), f"<p>{words(2, 6)}</p>{links()}")))] * some(0, 1)
        whole = "".join(before) + inner + "".join(after)
        if r.random() < 0.4:
            whole = f'<div class="{pick(("wrapper", "container", "page", "site", "layout"))}">{whole}</div>'
        page = parse(f"<html><head><title>{words(1, 4)}</title></head><body>{whole}</body></html>")
        y = [1] * len(page.parent)
        for i in range(1, len(y)):
            y[i] = int(y[page.parent[i]] and page.mark[i] != "0")
        made.append((page, y))
    return made


@functools.cache
def model() -> tuple[tuple[str, float], ...]:
    return tuple(sorted(train(labelled()).items()))


def main_text(html: str | None, w: dict[str, float]) -> str:
    """Kept text, in page order, blocks joined by one space; "" if none."""
    page = parse(html)
    p, _ = marginals(page, features(page), w)
    return " ".join(t for t, x in zip(page.text, p, strict=True) if t is not None and x >= 0.5)


def _extract(batches: Iterator[pa.RecordBatch], w: dict[str, float]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = [main_text(x.as_py(), w) for x in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of pages; a null or empty page has the text "". Further columns are not read."""
    read = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return in_batches(read).mapInArrow(functools.partial(_extract, w=dict(model())), "page_id long, url string, text string, n_chars long")


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


QUERIES = {"op2_html": op2_html}
ORACLES: dict[str, str] = {}
