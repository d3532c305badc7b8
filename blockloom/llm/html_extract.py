"""Main text of HTML pages: gradient-boosted trees over DOM-node features, decoded over the whole tree.

Every page is parsed into a tree (omitted end tags are supplied as browsers do, an unclosed comment, script or tag at the
end takes the rest).  Each element gets features: kind of tag, words of its class, id and role attributes, text and link
density of its subtree, depth, place among its siblings and how alike they are, and the same hints from its ancestors.
Boosted trees (Spark ML) score each element; :func:`decode` then keeps the set of elements with the largest summed score in
which no kept element lies in a dropped one, so an article stays whole and a menu within it goes as a whole.

The trees are fitted on at most ``SAMPLE_PAGES`` pages, those with the least hash of their id.  Their labels come from
semantic tags: what lies in ``article`` or ``main`` and not in a menu, form and the like is content, and so are its
ancestors.  Each sample page is also used in variants, in which the article sits in plain ``div`` elements and the menus,
notices, adverts, sidebars and comment lists that pages have around it are made of the sample's own sentences; so the trees
learn from attributes and densities what the tags tell in the original.  If no page of the table has such a tag, the sample
is of all pages: labels then come from attributes that name the article, and on a page without these from the share of
links in an element; menus, footers and the like are told by their tags and attributes as before.

Blocks are the text between block-level tags; references are decoded, white space becomes one space, blocks are joined by
a line feed.  Null or empty html gives an empty text; broken html gives the text of what was read.
"""

from __future__ import annotations

import html as htmllib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm.tables import each_batch, pick, stored

SAMPLE_PAGES = 150
TREES, DEPTH = 12, 4

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Tags that an opening tag of the given kind ends, if they are open within the nearest of the limits.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_ENDS_P = BLOCK - {"dd", "dt", "li", "td", "th", "tr", "tbody", "thead", "tfoot", "title", "head", "html", "body", "summary"}
_HOLDS_P = frozenset("article aside blockquote body button caption dd details div fieldset figure footer form header html li main nav object section table td th".split())
_INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup tt u var".split())

#: Words of attributes that name parts beside the article, and those that name the article.
BESIDE = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs byline comment comments cookie consent copyright disqus footer form gdpr header "
    "login masthead menu modal nav navbar navigation newsletter notice pagination pager popup promo recommended related reply replies respond "
    "search share sharing sidebar signup social sponsor sponsored subscribe tags toolbar widget".split()
)
MAIN = frozenset("article body content entry main page post story text".split())
KINDS = (
    {"article", "main"}, {"nav", "menu"}, {"header"}, {"footer"}, {"aside"}, {"form", "button", "input", "select", "label", "fieldset"}, {"p", "blockquote", "pre"},
    {"h1", "h2", "h3", "h4", "h5", "h6"}, {"ul", "ol", "dl"}, {"li", "dt", "dd"}, {"div"}, {"section"}, RAW | {"head", "meta", "link"}, {"a"}, _INLINE - {"a"}, {"table", "tr", "td", "th", "tbody"},
)
_KIND = {tag: i for i, tags in enumerate(KINDS) for tag in tags}
_BESIDE_TAGS = frozenset(["nav", "menu", "header", "footer", "aside", "form", "head", "dialog"]) | RAW
FEATURES = len(KINDS) + 18


@dataclass
class Node:
    tag: str
    up: int
    depth: int
    words: frozenset = frozenset()
    text: int = 0  # characters in the subtree
    links: int = 0  # of them in links
    marks: int = 0  # sentence marks in the subtree
    tags: int = 1  # elements in the subtree
    children: list[int] = field(default_factory=list)


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Elements in page order, the root first, and the texts with the element that holds each; breaks are (-1, '')."""
    nodes, texts, stack = [Node("#page", -1, 0)], [], [0]
    names = ["#page"]

    def pop(to: int) -> None:
        while len(stack) > to:
            stack.pop()
            if names.pop() in BLOCK:
                texts.append((-1, ""))

    at = 0
    n = len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            texts.append((stack[-1], page[at:]))
            break
        if m.start() > at:
            texts.append((stack[-1], page[at : m.start()]))
        at = m.end()
        closing, name, attributes = (m.group(1), m.group(2), m.group(3)) if m.group(2) else (m.group(4), m.group(5), m.group(6))
        if not name:
            continue
        name = name.lower()
        if closing:
            for i in range(len(names) - 1, 0, -1):
                if names[i] == name:
                    pop(i)
                    break
                if name in _INLINE and names[i] in BLOCK:
                    break  # an inline end tag closes nothing beyond its block
            continue
        if name in _ENDS_P:
            for i in range(len(names) - 1, 0, -1):
                if names[i] == "p":
                    pop(i)
                    break
                if names[i] in _HOLDS_P:
                    break
        if name in _ENDS:
            own, limits = _ENDS[name]
            for i in range(len(names) - 1, 0, -1):
                if names[i] in limits:
                    break
                if names[i] in own:
                    pop(i)
                    break
        words = frozenset()
        if attributes and ("=" in attributes):
            found = [w for a in _ATTRIBUTE.findall(attributes) for w in _WORDS.findall("".join(a[1:]).lower())]
            words = frozenset(found)
        up = stack[-1]
        nodes.append(Node(name, up, nodes[up].depth + 1, words))
        own = len(nodes) - 1
        nodes[up].children.append(own)
        if name == "br":
            texts.append((up, " "))
        if name in BLOCK:
            texts.append((-1, ""))
        if name in VOID or attributes.endswith("/") and name not in BLOCK:
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            texts.append((own, page[at : end.start() if end else n]))
            at = end.end() if end else n
            if name in BLOCK:
                texts.append((-1, ""))
            continue
        stack.append(own)
        names.append(name)
    return nodes, texts


def features(nodes: list[Node], texts: list[tuple[int, str]]) -> np.ndarray:
    """One row of FEATURES numbers for each element."""
    for node, text in texts:
        if node >= 0:
            own = nodes[node]
            k = len(text) if text.strip() else 0
            own.text += k
            own.marks += text.count(".") + text.count(",")
    n = len(nodes)
    for i in range(n - 1, 0, -1):
        own, up = nodes[i], nodes[nodes[i].up]
        if own.tag == "a":
            own.links = own.text
        up.text += own.text
        up.links += own.links
        up.marks += own.marks
        up.tags += own.tags
    whole = max(nodes[0].text, 1)
    out = np.zeros((n, FEATURES), np.float32)
    beside, inside, kinds = [False] * n, [False] * n, len(KINDS)
    for i, own in enumerate(nodes):
        row, up = out[i], nodes[own.up] if i else own
        kind = _KIND.get(own.tag)
        if kind is not None:
            row[kind] = 1
        b, m = not own.words.isdisjoint(BESIDE), not own.words.isdisjoint(MAIN)
        if i:
            beside[i] = b or own.tag in _BESIDE_TAGS or beside[own.up]
            inside[i] = own.tag in KINDS[0] or m or inside[own.up]
        density = own.links / own.text if own.text else 0.0
        row[kinds:] = (
            b, m, beside[own.up] if i else 0, inside[own.up] if i else 0, beside[i], inside[i],
            min(own.text, 100_000) ** 0.25, own.text / whole, density, own.marks / own.text if own.text else 0.0, own.text / own.tags, own.depth, len(own.children),
            len(up.children), (up.text - own.text) / max(up.text, 1), up.links / up.text if up.text else 0.0, 0.0, 0.0,
        )
    for own in nodes:
        if own.children:
            tags = [nodes[c].tag for c in own.children]
            k = len(tags)
            same = {t: tags.count(t) / k for t in set(tags)} if k < 50 else {t: c / k for t, c in zip(*np.unique(tags, return_counts=True))}
            for j, c in enumerate(own.children):
                out[c, -2] = j / k
                out[c, -1] = same[tags[j]]
    return out


def decode(nodes: list[Node], scores: np.ndarray) -> list[bool]:
    """The elements to keep: the largest sum of scores over sets that hold the parent of each member."""
    best = scores.astype(float).tolist()
    for i in range(len(nodes) - 1, 0, -1):
        if best[i] > 0:
            best[nodes[i].up] += best[i]
    keep = [True] * len(nodes)
    for i in range(1, len(nodes)):
        keep[i] = keep[nodes[i].up] and best[i] > 0
    return keep


def blocks(texts: list[tuple[int, str]], keep: list[bool]) -> str:
    """The kept texts, block by block."""
    out, held = [], []
    for node, text in [*texts, (-1, "")]:
        if node < 0:
            if held:
                block = " ".join(htmllib.unescape("".join(held)).split())
                if block:
                    out.append(block)
                held = []
        elif keep[node]:
            held.append(text)
        elif held and held[-1] != " ":
            held.append(" ")
    return "\n".join(out)


def _labels(nodes: list[Node]) -> list[bool] | None:
    """Content by semantic tags: elements in the article, without the parts beside it, and what holds the article."""
    inside, beside = [False] * len(nodes), [False] * len(nodes)
    for i, own in enumerate(nodes):
        if i:
            named = own.tag in _BESIDE_TAGS or not own.words.isdisjoint(BESIDE)
            beside[i] = beside[own.up] or named
            inside[i] = not beside[i] and (inside[own.up] or own.tag in KINDS[0])
    if not any(inside):
        return None
    for i in range(len(nodes) - 1, 0, -1):
        if inside[i]:
            inside[nodes[i].up] = True
    return inside


_HOLDERS = (("<main>", "</main>"), ('<div class="post-content">', "</div>"), ('<div id="content"><div class="entry">', "</div></div>"), ("<section><article>", "</article></section>"))


def variants(page: str, turn: int) -> Iterator[str]:
    """The page itself, and with other holders of the article and more parts around it, made of its own sentences."""
    yield page
    m = re.search(r"<article[^>]*>(.*?)</article>", page, re.S | re.I)
    if m is None:
        return
    article = m.group(1)
    sentences = [s for s in re.split(r"(?<=[.!?])\s+|<[^>]*>", article) if s][:60] or ["Text."]
    some = lambda k, n: " ".join((sentences * 3)[k % len(sentences) : k % len(sentences) + n])
    opened, closed = _HOLDERS[turn % len(_HOLDERS)]
    top = f'<header class="site-header"><div class="logo">{some(1, 1)}</div></header><div class="cookie-notice"><p>{some(2, 2)}</p></div><div class="breadcrumb"><a href="/">{some(3, 1)[:20]}</a></div>'
    side = f'<aside class="sidebar"><h3>{some(4, 1)[:30]}</h3><ul><li><a href="/a">{some(5, 1)}</a></li><li><a href="/b">{some(6, 1)}</a></li></ul><p>{some(7, 3)}</p></aside>'
    said = "".join(f'<div class="comment"><p class="author">{some(k, 1)[:12]}</p><p>{some(k + turn, 4)}</p></div>' for k in range(8, 12))
    tail = f'<section id="comments" class="comments"><h2>{some(8, 1)[:15]}</h2>{said}</section><form action="/s"><label>{some(9, 1)[:15]}</label><input name="q"><button>{some(10, 1)[:9]}</button></form><div class="related-posts"><a href="/c">{some(11, 1)}</a></div>'
    within = f'<div class="ad-banner">{some(12, 1)}</div>' if turn % 2 else ""
    middle = article.rfind("<p>")
    body = article[:middle] + within + article[middle:] if middle > 0 else article
    a, b = page[: m.start()], page[m.end() :]
    if turn % 3 == 0:
        body = f"{body}{tail}"
        tail = ""
    yield f"{a}{top}{opened}{body}{closed}{side}{tail}{b}"


def _dense_labels(nodes: list[Node]) -> list[bool]:
    """Content without any name for it: elements with more text of their own than links, apart from parts beside the article."""
    inside, beside = [False] * len(nodes), [False] * len(nodes)
    for i, own in enumerate(nodes):
        if i:
            beside[i] = beside[own.up] or own.tag in _BESIDE_TAGS or not own.words.isdisjoint(BESIDE)
            inside[i] = not beside[i] and (inside[own.up] if own.tag in _INLINE else own.text > 2 * own.links)
    for i in range(len(nodes) - 1, 0, -1):
        if inside[i]:
            inside[nodes[i].up] = True
    return inside


def _loose_labels(nodes: list[Node]) -> list[bool]:
    """By attributes that name the article, else by the density of links."""
    named = _variant_labels(nodes)
    return named if any(named) else _dense_labels(nodes)


def _training(loose: bool):
    """Features and labels of the sample; ``loose`` also takes pages without a semantic tag."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, labels = [], []
            for turn, page in zip(batch["turn"].to_pylist(), batch["html"].to_pylist()):
                for k, variant in enumerate(variants(page or "", turn)):
                    nodes, texts = parse(variant)
                    values = features(nodes, texts)
                    own = _variant_labels(nodes) if k else _labels(nodes)
                    if own is None and loose:
                        own = _loose_labels(nodes)
                    if own is not None:
                        rows.append(values)
                        labels += own
            if rows:
                yield pa.RecordBatch.from_pydict({"label": pa.array(np.array(labels, float)), "values": pa.array(np.concatenate(rows).astype(float).tolist(), pa.list_(pa.float64()))})

    return work


def _variant_labels(nodes: list[Node]) -> list[bool]:
    """As :func:`_labels`, where the holder may be an element with an attribute of the article's."""
    inside, beside = [False] * len(nodes), [False] * len(nodes)
    for i, own in enumerate(nodes):
        if i:
            beside[i] = beside[own.up] or own.tag in _BESIDE_TAGS or not own.words.isdisjoint(BESIDE)
            inside[i] = not beside[i] and (inside[own.up] or own.tag in KINDS[0] or not own.words.isdisjoint(MAIN))
    for i in range(len(nodes) - 1, 0, -1):
        if inside[i]:
            inside[nodes[i].up] = True
    return inside


class Trees:
    """The fitted trees as arrays: feature, threshold, left, right and value of each tree node."""

    def __init__(self, trees: list[tuple[float, list[tuple]]]):
        self.trees = [(w, *(np.array(c) for c in zip(*nodes))) for w, nodes in trees]

    @staticmethod
    def of(model) -> Trees:
        trees = []
        for weight, tree in zip(model.treeWeights, model._java_obj.trees()):
            nodes: list[list] = []

            def walk(node) -> int:
                at = len(nodes)
                nodes.append([0, 0.0, at, at, node.prediction()])
                if node.subtreeDepth() > 0:
                    split = node.split()
                    nodes[at][:2] = [split.featureIndex(), split.threshold()]
                    nodes[at][2] = walk(node.leftChild())
                    nodes[at][3] = walk(node.rightChild())
                return at

            walk(tree.rootNode())
            trees.append((float(weight), [tuple(x) for x in nodes]))
        return Trees(trees)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for weight, feature, threshold, left, right, value in self.trees:
            at = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH + 1):
                at = np.where(rows[every, feature[at]] <= threshold[at], left[at], right[at])
            total += weight * value[at]
        return total


def fit(pages: DataFrame, id: str = "page_id", html: str = "html", sample: int = SAMPLE_PAGES) -> Trees:
    """Boosted trees from at most ``sample`` pages with an article, or of all pages if no page has one.

    If no element of the sample lies beside its article, every element is kept.
    """
    from pyspark.ml.classification import GBTClassifier

    rows = pick(pages, id=id, html=html)
    marked = rows.where(F.lower("html").contains("<article") | F.lower("html").contains("<main"))
    for taken, loose in ((marked, False), (rows, True)):
        trained = stored(_sampled(taken, sample, loose))
        if trained.select("label").distinct().count() == 2:
            return Trees.of(GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, cacheNodeIds=False).fit(trained))
    return Trees([(1.0, [(0, 0.0, 0, 0, 1.0)])])


def _sampled(rows: DataFrame, sample: int, loose: bool) -> DataFrame:
    """(label, features) of the elements of the ``sample`` pages with the least hash of their id."""
    from pyspark.ml.functions import array_to_vector

    least = rows.select(F.xxhash64("id").alias("turn"), F.col("html")).orderBy("turn").limit(sample)
    dealt = least.select(F.pmod("turn", F.lit(12)).cast("int").alias("turn"), F.col("html").cast("string")).repartition(8, "turn")
    return dealt.mapInArrow(_training(loose), "label double, values array<double>").select("label", array_to_vector("values").alias("features"))


def _extracted(trees: Trees):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        parsed = [parse(page or "") for page in batch["html"].to_pylist()]
        rows = [features(*p) for p in parsed]
        scores = trees.scores(np.concatenate(rows))
        out, at = [], 0
        for (nodes, texts), own in zip(parsed, rows):
            out.append(blocks(texts, decode(nodes, scores[at : at + len(own)])))
            at += len(own)
        return pa.RecordBatch.from_pydict({"id": batch["id"], "url": batch["url"], "text": pa.array(out, pa.string()), "n_chars": pa.array(list(map(len, out)), pa.int64())})

    return each_batch(work)


def extract(pages: DataFrame, trees: Trees | None = None, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page."""
    trees = trees or fit(pages, id, html)
    rows = pick(pages, id=id, url=url, html=html).select("id", F.col("url").cast("string"), F.col("html").cast("string"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_extracted(trees), f"id {kind}, url string, text string, n_chars bigint").withColumnRenamed("id", id)
