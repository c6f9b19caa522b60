"""Main text of web pages: boosted trees over DOM nodes and a decoding that keeps ancestors and descendants consistent.

Every element of a page is described by its tag, its attribute words, text and link density of its subtree, depth, place and
siblings. Boosted trees give each the odds of holding main text. The decoding then picks the set of kept nodes of the highest
total likelihood in which every kept node's parent is kept, so a dropped menu cannot hold a kept entry.

The trees are fitted on at most ``sample_pages`` pages, chosen by a hash of their id. Pages with an article or main element
give labels by themselves; since a site's own tags would then decide everything, each is also laid out anew several times
with its text blocks in other wrappers, with menus, sidebars, notices, adverts, forms and reader comments around them.
"""

from __future__ import annotations

import random
import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm.boost import Boosted

SAMPLE_PAGES = 300
LAYOUTS = 3

# Element names of HTML by their role.
VOID = "area base br col embed hr img input link meta param source track wbr".split()
HIDDEN = frozenset("script style noscript template head title iframe svg object canvas math audio video".split())
# What the parser itself reads as raw text up to the end tag.
RAW = frozenset("script style".split())
BLOCK = (
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul"
).split()
CLOSES_P = set(BLOCK) - set("td th tr tbody thead tfoot option legend".split())
GROUPS = {
    "text": "p pre blockquote", "head": "h1 h2 h3 h4 h5 h6 hgroup", "box": "div section center", "main": "article main",
    "nav": "nav menu dir", "list": "ul ol dl", "item": "li dt dd", "link": "a", "top": "header", "foot": "footer", "side": "aside",
    "form": "form input button select label textarea option fieldset legend", "table": "table tbody thead tfoot tr td th",
    "root": "html body", "quote": "figure figcaption",
}
# Words of class, id and role attributes by what they usually mark.
MARKS = {
    "content": "content article post entry main story text body prose page",
    "menu": "nav menu navbar breadcrumb breadcrumbs navigation tabs toolbar links pagination pager toc",
    "edge": "header footer top bottom masthead banner copyright legal foot head site",
    "side": "sidebar aside related widget rail trending recommended popular side more share social tags meta author",
    "advert": "ad ads advert advertisement sponsor sponsored promo promoted adsense banner",
    "notice": "cookie cookies consent notice popup modal alert newsletter subscribe signup overlay gdpr message",
    "comment": "comment comments reply replies respond discussion disqus reader feedback thread",
    "form": "form search login input field contact",
}
GROUP_OF = {tag: i for i, tags in enumerate(GROUPS.values()) for tag in tags.split()}
MARK_OF = {}
for _i, _words in enumerate(MARKS.values()):
    for _w in _words.split():
        MARK_OF.setdefault(_w, []).append(_i)
SPACE = re.compile(r"\s+")
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
N_GROUPS, N_MARKS = len(GROUPS) + 1, len(MARKS)


class Node:
    __slots__ = ("tag", "marks", "parent", "parts", "index", "depth", "group")

    def __init__(self, tag: str, marks: set, parent: Node | None):
        self.tag, self.marks, self.parent, self.parts = tag, marks, parent, []
        self.depth = parent.depth + 1 if parent else 0
        self.group = GROUP_OF.get(tag, N_GROUPS - 1)
        self.index = 0


class Tree(HTMLParser):
    """Elements in page order; the text pieces and children of each in order. Open elements close as browsers do."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.hides = HIDDEN
        self._parse(html)
        if self.hidden:
            # A hidden element that never ends would hide all that follows: read again with its kind shown.
            opened = {t: len(re.findall(rf"<{t}[\s/>]", html, re.I)) - len(re.findall(rf"</{t}[\s/>]", html, re.I)) for t in HIDDEN - RAW}
            self.hides = HIDDEN - {t for t, more in opened.items() if more > 0}
            if self.hides != HIDDEN:
                self._parse(html)

    def _parse(self, html: str):
        self.root = Node("html", set(), None)
        self.nodes, self.stack, self.hidden = [self.root], [self.root], 0
        rest = html
        while True:
            self.reset()
            try:
                self.feed(rest)
                self.close()
                return
            except (AssertionError, ValueError):
                # The parser gives up on a broken declaration: its bracket is text, and reading goes on behind it.
                line, column = self.getpos()
                at = sum(len(x) + 1 for x in rest.split("\n", line - 1)[: line - 1]) + column
                self.handle_data(rest[at : at + 1])
                rest = rest[at + 1 :]

    def handle_starttag(self, tag, attrs):
        if self.hidden:
            if tag in self.hides and tag not in ("head", "title"):
                self.hidden += 1
            elif tag == "body":  # an unclosed head
                self.hidden = 0
            return
        if tag in ("html",):
            return
        if tag in self.hides:
            self.hidden = 1
            return
        if tag in CLOSES_P:
            self._close("p", "td th div article section main body li blockquote".split())
        if tag in ("li", "dt", "dd", "option", "tr", "td", "th"):
            for t in ("dt", "dd") if tag in ("dt", "dd") else (tag,):
                self._close(t, "ul ol dl table select".split())
        marks = set()
        for name, value in attrs:
            if value and name in ("class", "id", "role"):
                for word in TOKEN.findall(value):
                    marks.update(MARK_OF.get(word.lower(), ()))
        node = Node(tag, marks, self.stack[-1])
        node.index = len(self.nodes)
        self.stack[-1].parts.append(node)
        self.nodes.append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in self.hides and len(self.stack) > 1 and self.stack[-1].tag == tag and not self.hidden:
            self.stack.pop()
        elif tag in self.hides and self.hidden:
            self.hidden -= 1

    def _close(self, tag, walls):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return
            if self.stack[i].tag in walls:
                return

    def handle_endtag(self, tag):
        if self.hidden:
            if tag in self.hides:
                # A head that ends also ends what was left open in it.
                self.hidden = 0 if tag == "head" else max(self.hidden - 1, 0)
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        if not self.hidden:
            self.stack[-1].parts.append(data)


def features(tree: Tree) -> np.ndarray:
    """One row per node."""
    nodes = tree.nodes
    n = len(nodes)
    own, link, text, stops = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    tags, paras, begin = np.ones(n), np.zeros(n), np.zeros(n)
    size = 0
    for node in nodes:
        i = node.index
        begin[i] = size
        for part in node.parts:
            if isinstance(part, str):
                length = len(part.strip())
                own[i] += length
                size += length
                stops[i] += part.count(".") + part.count(",")
        text[i] = own[i]
        if node.tag == "a":
            link[i] = own[i]
        paras[i] = node.group == 0
    for node in reversed(nodes[1:]):  # children come after their parents
        p, i = node.parent.index, node.index
        text[p] += text[i]
        link[p] += link[i] if node.tag != "a" else text[i]
        stops[p] += stops[i]
        tags[p] += tags[i]
        paras[p] += paras[i]
    parent = np.array([x.parent.index if x.parent else 0 for x in nodes])
    group = np.array([x.group for x in nodes])
    out = np.zeros((n, 14 + 2 * N_GROUPS + 2 * N_MARKS))
    rank, kin = np.zeros(n), np.zeros(n)
    before, after = np.zeros(n), np.zeros(n)
    above = np.zeros((n, N_GROUPS + N_MARKS))
    for node in nodes:
        children = [c for c in node.parts if not isinstance(c, str)]
        last = None
        for k, c in enumerate(children):
            j = c.index
            rank[j], kin[j] = k, len(children)
            above[j] = above[node.index]
            above[j, node.group] = 1
            for m in node.marks:
                above[j, N_GROUPS + m] = 1
            if last is not None:
                before[j], after[last] = text[last], text[j]
            last = j
    total = max(text[0], 1)
    out[:, 0], out[:, 1], out[:, 2] = np.log1p(text), np.log1p(own), np.minimum(link / np.maximum(text, 1), 1)
    out[:, 3], out[:, 4], out[:, 5] = np.log1p(text / tags), np.array([x.depth for x in nodes]), np.log1p(tags)
    out[:, 6], out[:, 7], out[:, 8] = np.log1p(paras), stops / np.maximum(text, 1), text / total
    out[:, 9], out[:, 10] = rank / np.maximum(kin - 1, 1), np.log1p(kin)
    out[:, 11], out[:, 12], out[:, 13] = np.log1p(before), np.log1p(after), np.log1p(text[parent])
    out[np.arange(n), 14 + group] = 1
    for node in nodes:
        for m in node.marks:
            out[node.index, 14 + N_GROUPS + m] = 1
    out[:, 14 + N_GROUPS + N_MARKS :] = above
    return out


def decode(tree: Tree, odds: np.ndarray) -> np.ndarray:
    """The likeliest set of kept nodes that is closed under parents."""
    n = len(tree.nodes)
    no, yes = -np.logaddexp(0, odds), -np.logaddexp(0, -odds)
    drop, keep = no.copy(), yes.copy()
    for node in reversed(tree.nodes[1:]):
        p, i = node.parent.index, node.index
        drop[p] += drop[i]
        keep[p] += max(keep[i], drop[i])
    kept = np.zeros(n, bool)
    for node in tree.nodes:
        i = node.index
        kept[i] = keep[i] > drop[i] and (node.parent is None or kept[node.parent.index])
    return kept


def blocks_of(tree: Tree, kept: np.ndarray) -> list[str]:
    """Text blocks of kept nodes in page order."""
    out, line = [], []

    def flush():
        joined = SPACE.sub(" ", "".join(line)).strip()
        if joined:
            out.append(joined)
        line.clear()

    # An explicit stack: pages may nest deeper than Python's.
    work: list = [(tree.root, 0)]
    while work:
        node, at = work.pop()
        if at == 0:
            if not kept[node.index]:
                continue
            if node.tag in BLOCK:
                flush()
            if node.tag == "br":
                line.append(" ")
        descended = False
        for k in range(at, len(node.parts)):
            part = node.parts[k]
            if isinstance(part, str):
                line.append(part)
            else:
                if part.tag in BLOCK and not kept[part.index]:
                    flush()
                work.append((node, k + 1))
                work.append((part, 0))
                descended = True
                break
        if not descended and node.tag in BLOCK:
            flush()
    flush()
    return out


BOILER = set("nav menu aside footer form".split())


def silver(tree: Tree) -> np.ndarray | None:
    """Labels of a page with one article or main element: kept are its text and all that holds it."""
    mains = [x for x in tree.nodes if x.tag in ("article", "main")]
    mains = [x for x in mains if x.tag == "article"] or mains
    if not mains:
        return None
    label = np.zeros(len(tree.nodes))
    bad = {list(MARKS).index(m) for m in ("menu", "advert", "notice", "comment", "form")}
    inside = np.zeros(len(tree.nodes), bool)
    for node in tree.nodes:
        i = node.index
        under = inside[node.parent.index] if node.parent else False
        inside[i] = (node in mains or under) and node.tag not in BOILER and not (node.marks & bad)
    for node in tree.nodes:
        if inside[node.index]:
            label[node.index] = 1
            up = node.parent
            while up is not None and not label[up.index]:
                label[up.index] = 1
                up = up.parent
    return label


class Layout:
    """Writes a page around given main blocks and remembers which nodes hold main text."""

    def __init__(self, rng: random.Random, main: list[str], spare: list[str]):
        self.rng, self.main, self.spare = rng, main, spare

    def short(self, words: int) -> str:
        pick = self.rng.choice(self.spare).split()
        at = self.rng.randrange(max(len(pick) - words, 1))
        return " ".join(pick[at : at + words]).replace("<", " ").replace("&", " ")

    def wrap(self, kinds: list[tuple[str, str]], inner: str, plain: float = 0.15) -> str:
        tag, marks = self.rng.choice(kinds)
        word = self.rng.choice(marks.split()) if marks else ""
        attr = "" if not word or self.rng.random() < plain else f' {self.rng.choice(["class", "id", "class"])}="{word}"'
        return f"<{tag}{attr}>{inner}</{tag}>"

    def menu(self) -> str:
        items = [f'<a href="/x">{self.short(self.rng.randint(1, 3))}</a>' for _ in range(self.rng.randint(3, 9))]
        inner = "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>" if self.rng.random() < 0.7 else " | ".join(items)
        return self.wrap([("nav", MARKS["menu"]), ("div", MARKS["menu"]), ("ul", MARKS["menu"])], inner)

    def side(self) -> str:
        items = "".join(f'<li><a href="/y">{self.short(self.rng.randint(2, 7))}</a></li>' for _ in range(self.rng.randint(2, 6)))
        return self.wrap([("aside", MARKS["side"]), ("div", MARKS["side"])], f"<h3>{self.short(2)}</h3><ul>{items}</ul>" + (f"<p>{self.short(9)}</p>" if self.rng.random() < 0.4 else ""), 0.05)

    def advert(self) -> str:
        return self.wrap([("div", MARKS["advert"]), ("aside", MARKS["advert"])], self.short(self.rng.randint(4, 14)), 0)

    def notice(self) -> str:
        button = "<button>OK</button>" if self.rng.random() < 0.5 else ""
        return self.wrap([("div", MARKS["notice"]), ("section", MARKS["notice"])], f"<p>{self.short(self.rng.randint(6, 20))}</p>{button}", 0)

    def form(self) -> str:
        return self.wrap([("form", MARKS["form"]), ("form", "")], f'<label>{self.short(2)}</label><input type="text"><button>{self.short(1)}</button>')

    def comments(self) -> str:
        one = lambda: self.wrap([("div", "comment reply"), ("li", "comment reply"), ("article", "comment")], f"<b>{self.short(1)}</b><p>{self.short(self.rng.randint(4, 30))}</p>", 0)
        return self.wrap([("section", "comments discussion respond"), ("div", "comments discussion thread"), ("ol", "comments")], "<h3>" + self.short(1) + "</h3>" + "".join(one() for _ in range(self.rng.randint(1, 5))), 0)

    def edge(self, top: bool) -> str:
        return self.wrap([("header" if top else "footer", MARKS["edge"]), ("div", "header masthead top" if top else "footer copyright bottom legal")], f"<p>{self.short(self.rng.randint(3, 12))}</p>" if self.rng.random() < 0.5 else self.short(self.rng.randint(3, 12)))

    def cut(self, text: str, chance: float) -> str:
        """Now and then only a few words of a block: headings and lines of an article are often short."""
        words = text.split()
        if len(words) < 2 or self.rng.random() >= chance:
            return text
        size = self.rng.randint(1, 6)
        at = self.rng.randrange(max(len(words) - size, 1))
        return " ".join(words[at : at + size])

    def page(self) -> str:
        r = self.rng
        texts = [self.cut(t, 0.1 if k else 0.6).replace("&", "&amp;").replace("<", "&lt;") for k, t in enumerate(self.main)]
        parts = [f'<{r.choice(["h1", "h1", "h2"])} data-main>{texts[0]}</h1>'.replace("</h1>", "")] if texts else []
        if parts:
            tag = parts[0][1:3]
            parts[0] += f"</{tag}>"
        for t in texts[1:]:
            if r.random() < 0.12:
                level = r.choice(["h2", "h3", "h4"])
                parts.append(f"<{level} data-main>{self.short(r.randint(1, 7))}</{level}>")
            kind = r.random()
            parts.append(f"<p data-main>{t}</p>" if kind < 0.8 else f"<ul data-main><li data-main>{t}</li></ul>" if kind < 0.86 else f"<blockquote data-main>{t}</blockquote>" if kind < 0.92 else f"<div data-main>{t}</div>")
            if r.random() < 0.06:
                parts.append(r.choice([self.advert, self.side, self.notice])())
        if r.random() < 0.3:
            parts.append(self.comments())
        main = self.wrap([("article", MARKS["content"]), ("main", MARKS["content"]), ("div", MARKS["content"]), ("section", MARKS["content"]), ("article", "")], "".join(parts), 0.2)
        if r.random() < 0.4:
            main = f'<div class="{r.choice(["wrapper", "container", "row", "content"])}">{main}{self.side() if r.random() < 0.5 else ""}</div>'
        before = [f() for f in (self.menu, lambda: self.edge(True), self.advert, self.notice, self.form) if r.random() < 0.5]
        after = [f() for f in (self.comments, self.side, self.advert, self.form, lambda: self.edge(False), self.menu) if r.random() < 0.45]
        r.shuffle(before)
        r.shuffle(after)
        return "<html><body>" + "".join(before) + main + "".join(after) + "</body></html>"


class MarkedTree(Tree):
    """A laid-out page with the labels its marks give."""

    def __init__(self, html: str):
        self.main: list[int] = []
        super().__init__(html)

    def handle_starttag(self, tag, attrs):
        super().handle_starttag(tag, [a for a in attrs if a[0] != "data-main"])
        if any(a[0] == "data-main" for a in attrs):
            self.main.append(self.nodes[-1].index)

    def labels(self) -> np.ndarray:
        label = np.zeros(len(self.nodes))
        for i in self.main:
            node = self.nodes[i]
            while node is not None and not label[node.index]:
                label[node.index] = 1
                node = node.parent
        return label


FILLER = ["one two three four five six seven eight nine ten eleven twelve thirteen fourteen, and so on to the end of the line."]


def train(pages: list[tuple[int, str]], layouts: int = LAYOUTS, seed: int = 3) -> Boosted:
    """Fit on sampled pages; without any, on layouts of filler text."""
    rng = random.Random(seed)
    x, y, mains, spare = [], [], [], []
    for _, html in pages:
        tree = Tree(html or "")
        label = silver(tree)
        found = blocks_of(tree, np.ones(len(tree.nodes), bool) if label is None else label > 0)
        if found:
            spare += found[:6]
        if label is not None and found:
            x.append(features(tree)), y.append(label)
            mains.append(found[:40])
    spare = spare or FILLER
    for main in (mains or [FILLER * 5] * 20) * layouts:
        cut = main[: rng.randint(2, max(2, len(main)))]
        tree = MarkedTree(Layout(rng, cut, spare).page())
        x.append(features(tree)), y.append(tree.labels())
    return Boosted.fit(np.concatenate(x), np.concatenate(y))


def sample(pages: DataFrame, ident: str, html: str, size: int) -> list[tuple[int, str]]:
    """At most ``size`` pages, by a hash of their id."""
    ids = pages.where(F.col(html).isNotNull()).select(ident).orderBy(F.xxhash64(F.col(ident)), F.col(ident)).limit(size).distinct()
    rows = pages.where(F.col(html).isNotNull()).join(F.broadcast(ids), ident).select(ident, html)
    return [(r[0], r[1]) for r in rows.orderBy(F.xxhash64(F.col(ident)), F.col(ident)).limit(size).collect()]


def extract_text(pages: DataFrame, model: Boosted, html: str = "html", text: str = "text", group: int = 200) -> DataFrame:
    """All rows of pages plus their main text; null and empty pages give the empty text."""
    shipped = pages.sparkSession.sparkContext.broadcast(model)
    docs = pages.drop(text)
    at = docs.columns.index(html)

    def run(batches):
        for batch in batches:
            out = []
            source = batch.column(at)
            for first in range(0, batch.num_rows, group):
                trees = [Tree(h or "") for h in source.slice(first, group).to_pylist()]
                odds = shipped.value.log_odds(np.concatenate([features(t) for t in trees]))
                cuts = np.cumsum([len(t.nodes) for t in trees])[:-1]
                for tree, o in zip(trees, np.split(odds, cuts)):
                    out.append("\n".join(blocks_of(tree, decode(tree, o))))
            yield pa.RecordBatch.from_arrays(batch.columns + [pa.array(out, pa.string())], names=batch.schema.names + [text])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"`{text}` string"])
    return docs.mapInArrow(run, schema)


def op5_extract(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    model = train(sample(pages, "page_id", "html", SAMPLE_PAGES))
    return extract_text(pages, model).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
