"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the hierarchy."""

from __future__ import annotations

import html as entities
import pickle
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkdex.llm.common import batch_of, slices

# Pages that a model is fitted on, those of the smallest hashes, and rewritten copies of each.
TRAINING_PAGES, REWRITES = 300, 3
TREES, DEPTH, RATE, BINS, LEAST_ROWS = 40, 4, 0.3, 32, 5

# Log-odds against an element that is a form.
FORM_ODDS = 10.0

# Kinds of elements by name.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title".split())
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.I | re.A) for name in RAW}
# Elements of their own that do not end a block of text, and what stands inside of them as part of a line.
EMBEDDED = frozenset("math svg object noscript template iframe select textarea".split())
INLINE = frozenset(
    "a abbr b bdi bdo big br button cite code data del dfn em font i img input ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr "
    "mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle mpadded mphantom semantics "
    "annotation circle defs desc ellipse g line path polygon polyline rect symbol text tspan use".split()
)
# An element of these kinds ends an open paragraph; the others end an open one of the same kind.
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu "
    "nav ol p pre section table ul".split()
)
ENDS_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
LISTS = frozenset("ul ol dl table tbody thead".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++))""")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

# Tokens of names, classes, ids and roles that tell what an element is for.
TOKENS = {
    "content": "article main content post entry story body text blog page".split(),
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs toc pager pagination tabs".split(),
    "header": "header masthead head top topbar banner logo".split(),
    "footer": "footer foot bottom copyright legal colophon contentinfo".split(),
    "side": "aside sidebar side rail related recommended widget complementary teaser".split(),
    "advert": "ad ads adv advert advertisement sponsor sponsored promo promotion".split(),
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay dialog newsletter subscribe".split(),
    "comment": "comment comments reply replies disqus discussion respond reader".split(),
    "form": "form search login signup input share social button".split(),
}
_KIND_OF = {token: number for number, tokens in enumerate(TOKENS.values()) for token in tokens}
_NAMES = ("p", "article", "main", "section", "div", "header", "footer", "nav", "aside", "form", "blockquote", "pre")
_ONE_OF_NAMES = {name: [name == n for n in _NAMES] for name in _NAMES}
_NO_NAME, _NO_KIND = [False] * len(_NAMES), [False] * len(TOKENS)


@dataclass
class Element:
    name: str
    parent: int
    depth: int
    kinds: frozenset[int]
    mark: str = ""
    children: list[int] = field(default_factory=list)
    own: int = 0  # characters of text outside child elements
    chars: int = 0
    linked: int = 0
    stops: int = 0
    paragraphs: int = 0
    size: int = 1


class Page:
    """The elements of a page and its text in order: pieces (element, text), a block ends where text is None."""

    def __init__(self, source: str) -> None:
        self.elements = [Element("", -1, 0, frozenset())]
        self.pieces: list[tuple[int, str | None]] = []
        self._parse(source)
        for element in reversed(self.elements[1:]):
            element.chars += element.own
            above = self.elements[element.parent]
            for name in ("chars", "linked", "stops", "paragraphs", "size"):
                setattr(above, name, getattr(above, name) + getattr(element, name))
        self.elements[0].chars += self.elements[0].own

    def _parse(self, source: str) -> None:
        open_, links, at = [(0, "")], 0, 0
        while found := _TAG.search(source, at):
            self._text(open_[-1][0], source[at : found.start()], links)
            at = found.end()
            closing, name, attributes = found[1], (found[2] or "").lower(), found[3] or ""
            if not name:
                continue
            if closing:
                if any(name == n for _, n in open_[1:]):
                    while open_[-1][1] != name:
                        links -= open_.pop()[1] == "a"
                    open_.pop()
                    links -= name == "a"
                if name not in INLINE and name not in EMBEDDED:
                    self.pieces.append((open_[-1][0], None))
                continue
            if name in RAW and not (name == "title" and any(n == "svg" for _, n in open_)):
                if not attributes.endswith("/"):
                    end = _RAW_END[name].search(source, at)
                    at = end.end() if end else len(source)
                continue
            if name not in INLINE and name not in EMBEDDED:
                self.pieces.append((open_[-1][0], None))
            if name in VOID or attributes.endswith("/"):
                if name == "br":
                    self._text(open_[-1][0], " ", links)
                continue
            ends = ENDS_SAME.get(name) or ({"p"} if name in ENDS_P else ())
            for place in range(len(open_) - 1, 0, -1):
                if open_[place][1] in ends:
                    links -= sum(n == "a" for _, n in open_[place:])
                    del open_[place:]
                    break
                if open_[place][1] in LISTS or open_[place][1] in ("div", "section", "article", "main", "body"):
                    break
            kinds, mark = self._kinds(name, attributes)
            number = open_[-1][0]
            if name not in INLINE or kinds:
                above = self.elements[number]
                element = Element(name, number, above.depth + 1, kinds, mark, paragraphs=int(name == "p"))
                above.children.append(len(self.elements))
                number = len(self.elements)
                self.elements.append(element)
            open_.append((number, name))
            links += name == "a"
        self._text(open_[-1][0], source[at:], links)

    @staticmethod
    def _kinds(name: str, attributes: str) -> tuple[frozenset[int], str]:
        tokens, mark = [name] if name not in INLINE else [], ""
        for found in _ATTRIBUTE.finditer(attributes) if attributes else ():
            key, value = found[1].lower(), found[2] or found[3] or found[4] or ""
            if key in ("class", "id", "role"):
                tokens.extend(t.lower() for t in _TOKEN.findall(value))
            elif key == "data-mark":
                mark = value
        return frozenset(_KIND_OF[t] for t in tokens if t in _KIND_OF), mark

    def _text(self, number: int, text: str, links: int) -> None:
        if not text:
            return
        text = entities.unescape(text)
        element, n = self.elements[number], len(text.strip())
        element.own += n
        element.linked += n if links else 0
        element.stops += sum(map(text.count, ".,;:!?")) if n else 0
        self.pieces.append((number, text))

    def features(self) -> np.ndarray:
        """One row per element: subtree density, attribute tokens, depth, and siblings."""
        rows = []
        above = [(False, False)] * len(self.elements)  # is an ancestor's kind one of the rest, is one content
        whole, alike = max(self.elements[0].chars, 1), []
        place, before = [0] * len(self.elements), [0] * len(self.elements)
        for number, e in enumerate(self.elements):
            alike.append(Counter(self.elements[child].name for child in e.children))
            last = 0
            for i, child in enumerate(e.children):
                place[child], before[child], last = i, last, self.elements[child].chars
            up = self.elements[max(e.parent, 0)]
            if number:
                h, c = above[e.parent]
                above[number] = (h or bool(up.kinds - {0}), c or 0 in up.kinds)
            siblings = len(up.children) or 1
            same = alike[e.parent][e.name] if number else 1
            rows.append(
                [
                    e.depth,
                    log1p(e.chars),
                    log1p(e.own),
                    e.linked / max(e.chars, 1),
                    e.chars / whole,
                    e.size / (1 + e.chars / 100),
                    log1p(len(e.children)),
                    log1p(e.paragraphs),
                    place[number] / siblings,
                    log(siblings),
                    same / siblings,
                    e.chars / max(up.chars, 1),
                    log1p((up.chars - e.chars) / max(siblings - 1, 1)),
                    100 * e.stops / max(e.chars, 1),
                    log1p(before[number]),
                    len(e.name) == 2 and e.name[0] == "h",
                    e.name in LISTS or e.name in ENDS_SAME,
                    *above[number],
                    *_ONE_OF_NAMES.get(e.name, _NO_NAME),
                    *([k in e.kinds for k in range(len(TOKENS))] if e.kinds else _NO_KIND),
                ]
            )
        return np.array(rows, np.float64)

    def text(self, kept: np.ndarray) -> str:
        """The text of kept elements: white space becomes one space, blocks are lines."""
        blocks, current = [], []
        for number, text in [*self.pieces, (0, None)]:
            if text is None:
                block = " ".join("".join(current).split())
                if block:
                    blocks.append(block)
                current = []
            elif kept[number]:
                current.append(text)
        return "\n".join(blocks)


class Trees:
    """Gradient-boosted regression trees for the log-odds of a 0/1 label."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray) -> None:
        rate = (labels.sum() + 0.5) / (len(labels) + 1)
        self.start = float(np.log(rate / (1 - rate)))
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in rows.T]
        binned = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, rows.T, strict=True)], axis=1)
        score = np.full(len(rows), self.start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            gradient, weight = labels - p, np.maximum(p * (1 - p), 1e-6)
            tree = self._grow(binned, cuts, gradient, weight)
            self.trees.append(tree)
            score += self._apply(tree, rows)

    @staticmethod
    def _grow(binned, cuts, gradient, weight) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A full tree as arrays in heap order: feature (-1: none), threshold, and the values of all nodes."""
        feature, threshold = np.full(2**DEPTH - 1, -1), np.zeros(2**DEPTH - 1)
        value, node = np.zeros(2 ** (DEPTH + 1) - 1), np.zeros(len(binned), np.int64)
        for at in range(len(value)):
            rows = np.flatnonzero(node == at)
            if not len(rows):
                continue
            g, w = gradient[rows], weight[rows]
            value[at] = RATE * g.sum() / (w.sum() + 1.0)
            if at >= len(feature):
                continue
            best, total = 1e-6, g.sum() ** 2 / (w.sum() + 1.0)
            for column, edges in enumerate(cuts):
                if not len(edges):
                    continue
                size = len(edges) + 1
                b = binned[rows, column]
                gs, ws, n = (np.cumsum(np.bincount(b, x, size))[:-1] for x in (g, w, np.ones(len(b))))
                gain = gs**2 / (ws + 1.0) + (g.sum() - gs) ** 2 / (w.sum() - ws + 1.0) - total
                gain[(n < LEAST_ROWS) | (len(rows) - n < LEAST_ROWS)] = 0
                if gain.max() > best:
                    best, feature[at], threshold[at] = gain.max(), column, edges[gain.argmax()]
            if feature[at] >= 0:
                right = binned[rows, feature[at]] > np.searchsorted(cuts[feature[at]], threshold[at])
                node[rows] = 2 * at + 1 + right
        return feature, threshold, value

    @staticmethod
    def _apply(tree, rows: np.ndarray) -> np.ndarray:
        feature, threshold, value = tree
        node = np.zeros(len(rows), np.int64)
        for _ in range(DEPTH):
            inner = np.minimum(node, len(feature) - 1)
            split = (node < len(feature)) & (feature[inner] >= 0)
            right = rows[np.arange(len(rows)), feature[inner]] > threshold[inner]
            node = np.where(split, 2 * node + 1 + right, node)
        return value[node]

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        return self.start + sum(self._apply(tree, rows) for tree in self.trees)


def decode(page: Page, log_odds: np.ndarray) -> np.ndarray:
    """Which elements are main text, so that the sum of agreeing log-odds is greatest along the hierarchy.

    From the root down a path is outside, may enter the main text once, and may leave it once; below
    an element that has been left nothing is kept, whatever its own odds. Elements count by their text.
    """
    elements = page.elements
    gain = log_odds * np.array([1 + np.sqrt(e.own) for e in elements])
    for number, e in enumerate(elements):
        if e.name == "form" and 2 * e.chars < elements[0].chars:  # a form, and not one around the whole page
            gain[number] = -FORM_ODDS * (1 + np.sqrt(e.chars))
    outside, inside = np.zeros(len(elements)), np.zeros(len(elements))
    left = -gain  # the whole subtree is left
    for number in range(len(elements) - 1, -1, -1):
        children = elements[number].children
        outside[number] = -gain[number] + sum(max(outside[c], inside[c]) for c in children)
        inside[number] = gain[number] + sum(max(inside[c], left[c]) for c in children)
        left[number] += sum(left[c] for c in children)
    kept, state = np.zeros(len(elements), bool), [""] * len(elements)
    for number, e in enumerate(elements):
        above = state[e.parent] if number else "outside"
        if above == "outside":
            state[number] = "inside" if inside[number] > outside[number] else "outside"
        elif above == "inside":
            state[number] = "inside" if inside[number] > left[number] else "left"
        else:
            state[number] = "left"
        kept[number] = state[number] == "inside"
    return kept


_ARTICLE = re.compile(r"<article\b[^>]*>.*?(?:</article>|\Z)", re.S | re.I)


def _shortened(blocks: list[str], pick: random.Random, always: bool = False) -> list[str]:
    """Some of the time a short article: few blocks of few words."""
    if not always and pick.random() < 0.6:
        return blocks
    return [" ".join(b.split()[: pick.randint(1, 12)]) for b in blocks[: pick.randint(1, 4)]]


def _rewritten(blocks: list[str], other: list[str], pick: random.Random) -> str:
    """A page of another make around the same article; elements carry marks: c for content, b for the rest."""

    def escaped(text: str) -> str:
        return entities.escape(text, quote=False)

    def box(kind: str, mark: str, inner: str, names: tuple[str, ...] = ("div",)) -> str:
        token = pick.choice(TOKENS[kind])
        name = pick.choice(names)
        form = pick.choice([f' class="{token}"', f' id="{token}"', f' class="site-{token} box"', f' class="{token}-wrap"'])
        bare = name in ("nav", "article", "main", "aside", "header", "footer", "form") and pick.random() < 0.5
        return f'<{name}{"" if bare else form} data-mark="{mark}">{inner}</{name}>'

    def some(n: int) -> str:
        words = " ".join(other).split() or ["x"]
        start = pick.randrange(len(words))
        return escaped(" ".join((words[start:] + words)[:n]))

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{some(pick.randint(1, 3))}</a></li>' for i in range(n)) + "</ul>"

    body = [f"<h1>{escaped(blocks[0])}</h1>", *(f"<p>{escaped(b)}</p>" for b in blocks[1:])]
    extras = [
        box("advert", "b", f"<p>{some(pick.randint(3, 40))}</p>", ("div", "aside", "section")),
        box("form", "b", f"<p>{some(4)}</p><input name=q><button>{some(1)}</button>", ("form",)),
        box("side", "b", f"<h3>{some(2)}</h3><p>{some(pick.randint(3, 30))}</p>{links(3)}", ("aside", "div")),
        box("notice", "b", f"<p>{some(pick.randint(5, 30))}</p>", ("div", "section")),
    ]
    for extra in pick.sample(extras, pick.randint(0, 2)):
        body.insert(pick.randrange(len(body) + 1), extra)
    heading = f"<h3>{some(pick.randint(1, 3))}</h3>" if pick.random() < 0.7 else ""
    inner = pick.choice(["<div><p>{}</p></div>", '<div class="comment"><p>{}</p></div>', "<li><p>{}</p></li>", "<p>{}</p>"])
    comments = "".join(inner.format(some(pick.randint(5, 60))) for _ in range(pick.randint(1, 4)))
    comments = box("comment", "b", heading + comments, ("div", "section"))
    if pick.random() < 0.4:
        body.append(comments)
    article = box("content", "c", "".join(body), ("div", "article", "main", "section"))
    before = [
        box("header", "b", f"<p>{some(3)}</p>", ("header", "div")),
        box("menu", "b", links(pick.randint(3, 8)), ("nav", "div")),
        *pick.sample(extras, 2),
    ]
    after = [comments, box("footer", "b", f"<p>&copy; {some(pick.randint(3, 20))}</p>", ("footer", "div")), *pick.sample(extras, 2)]
    parts = [*(x for x in before if pick.random() < 0.6), article, *(x for x in after if pick.random() < 0.6)]
    inner = "".join(parts)
    return f"<html><body>{f'<div>{inner}</div>' if pick.random() < 0.4 else inner}</body></html>"


def _labelled(page: Page) -> np.ndarray:
    """Label per element: its mark, else that of the element above; article and main say so by name."""
    labels = np.zeros(len(page.elements), np.int64)
    names = {"article": 1, "main": 1, "nav": 0, "aside": 0, "footer": 0, "header": 0, "form": 0}
    for number, e in enumerate(page.elements[1:], 1):
        above = labels[e.parent]
        told = names.get(e.name, 0 if e.kinds - {0} and e.name not in ("body", "html") else above)
        labels[number] = {"c": 1, "b": 0}.get(e.mark, told)
    return labels


def train(sources: list[str]) -> Trees | None:
    """A model from pages that mark their article, as they are and rewritten in other makes; None without any."""
    rows, labels = [], []
    for source in sources:
        page = Page(source)
        known = _labelled(page)
        blocks = page.text(known == 1).split("\n")
        if not blocks[0]:
            continue
        rows.append(page.features())
        labels.append(known)
        other = page.text(known == 0).split("\n")
        pick = random.Random(source)
        for _ in range(REWRITES):
            made = Page(_rewritten(_shortened(blocks, pick), other, pick))
            rows.append(made.features())
            labels.append(_labelled(made))
        short = _shortened(blocks, pick, always=True)
        body = "".join(f"<p>{entities.escape(b, quote=False)}</p>" for b in short)
        made = Page(_ARTICLE.sub(lambda _: f"<article>{body}</article>", source, count=1))
        rows.append(made.features())
        labels.append(_labelled(made))
    return Trees(np.concatenate(rows), np.concatenate(labels)) if rows else None


# Pages that can say what is main text.
LABELLED = r"(?i)<(article|main)[\s/>]"

_MODEL = pa.schema([("model", pa.binary())])


def fit(pages: DataFrame, max_pages: int = TRAINING_PAGES) -> Trees | None:
    """Fit on at most ``max_pages`` different texts of ``pages`` (html) that hold an article or main element, those of the smallest
    hashes, in one task.

    Labels come from the pages: elements named article and main hold the main text. Each page is
    also rewritten with other names, classes and surroundings, so that the model does not lean on those names.
    """
    html = F.col("html").cast("string").alias("html")
    labelled = pages.where(html.rlike(LABELLED)).select(html, F.xxhash64(html).alias("place"))
    # Hashes are chosen first, so that only the chosen pages are exchanged, and of repeated ones one copy of each task.
    chosen = labelled.select("place").distinct().orderBy("place").limit(max_pages)
    sample = labelled.join(F.broadcast(chosen), "place").groupBy("place").agg(F.min("html").alias("html")).select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sources = [source for batch in batches for source in batch.column("html").to_pylist()]
        yield batch_of(_MODEL, [[pickle.dumps(train(sorted(sources)))]])

    made = sample.repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(made["model"]) if made else None


_TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])


def extract(pages: DataFrame, model: Trees | None) -> DataFrame:
    """(page_id, url, text) per row of ``pages`` (page_id, url, html): the main text of the whole page.

    Scripts, styles, the page's title, comments and markup never are text; of the rest the model
    decides by element. Character references are decoded, white space inside a block (``br`` included)
    becomes one space, blocks are joined by line breaks. Null and empty pages, pages without main
    text, and all pages if there was nothing to fit a model on, have the empty text; repeated rows stay, an
    empty table gives no rows, and further columns are not read.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, 64):
            parsed = [Page(source or "") for source in batch.column("html").to_pylist()]
            if model is None:
                texts = [""] * len(parsed)
            else:
                features = [page.features() for page in parsed]
                odds = np.split(model.log_odds(np.concatenate(features)), np.cumsum([len(f) for f in features])[:-1])
                texts = [page.text(decode(page, o)) for page, o in zip(parsed, odds, strict=True)]
            yield batch_of(_TEXTS, [batch.column("page_id"), batch.column("url"), texts])

    columns = [F.col("page_id").cast("bigint").alias("page_id"), *(F.col(c).cast("string").alias(c) for c in ("url", "html"))]
    return pages.select(*columns).mapInArrow(run, "page_id bigint, url string, text string")
