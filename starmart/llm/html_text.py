"""Main text of web pages by a graphical model over the DOM tree.

Every node of a page is content (1) or not (0). A node's own look gives evidence
for either; a potential on each edge ties it to its parent. The edges form a tree,
so one pass of messages up and one down give exact marginals. Evidence and edge potentials are
counted from labelled pages.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Pages of the table that are labelled by their landmarks and learned from, about.
SAMPLE = 400

# Fixed values of HTML: elements without content, without rendered text, and of inline kind.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = frozenset("script style noscript template head title svg math object iframe select textarea button".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr img #text".split()
)
# Fixed values of HTML: what an opening element closes, up to the element that bounds the search.
CLOSES = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "option": (frozenset({"option"}), frozenset({"select"})),
}
CLOSE_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr main menu nav ol p pre section table ul".split()
)

TOP = frozenset({"#root", "html", "body"})

# Stems of names that authors give to parts of a page.
APART = (
    "nav menu header masthead footer foot sidebar side aside ad ads advert banner promo sponsor cookie consent"
    " notice alert comment comments reply respond discuss share social related recommend form login signin"
    " newsletter subscribe breadcrumb widget popup modal toolbar pagination pager tag tags meta search copyright"
    " disqus thread gdpr privacy kommentare commentaires comentarios werbung anzeige publicite publicidad hinweis aviso"
).split()
MAIN = "article content post entry story main body text".split()
_NAME = re.compile(r"[A-Za-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
# Log potential of a state that a node cannot have.
_NEVER = -1e6
# How often each written page counts.
WRITTEN = 4


@dataclass
class Page:
    """Nodes in page order; a parent comes before its children."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    names: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    labels: list[str | None] = field(default_factory=list)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.page, self.open = Page(), [0]
        # Open elements by tag: no stack is walked for an end that has no start.
        self.opened: Counter = Counter()
        self._add("#root", -1)

    def _add(self, tag: str, parent: int, name: str = "", text: str = "", label: str | None = None) -> int:
        p = self.page
        for values, value in ((p.tags, tag), (p.parents, parent), (p.names, name), (p.texts, text), (p.labels, label)):
            values.append(value)
        return len(p.tags) - 1

    def _close_from(self, k: int) -> None:
        self.opened.subtract(self.page.tags[node] for node in self.open[k:])
        del self.open[k:]

    def _close(self, ends: frozenset, bounds: frozenset) -> None:
        if not any(self.opened[tag] for tag in ends):
            return
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.page.tags[self.open[k]]
            if tag in ends:
                self._close_from(k)
                return
            if tag in bounds:
                return

    def handle_starttag(self, tag, attrs):
        if tag in CLOSE_P:
            self._close(frozenset({"p"}), frozenset({"td", "th", "table", "button", "article", "section", "div"}))
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        given = dict(attrs)
        name = " ".join(given.get(a) or "" for a in ("class", "id", "role"))
        node = self._add(tag, self.open[-1], name, label=given.get("data-label"))
        if tag not in VOID:
            self.open.append(node)
            self.opened[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not self.opened[tag]:
            return
        for k in range(len(self.open) - 1, 0, -1):
            if self.page.tags[self.open[k]] == tag:
                self._close_from(k)
                return

    def handle_data(self, data):
        self._add("#text", self.open[-1], text=data)


def parse(html: str) -> Page:
    """The DOM of a page; any text parses, unclosed and stray tags included."""
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.page


@lru_cache(maxsize=4_096)
def _stem(name: str) -> str:
    words = [w.lower() for w in _NAME.findall(_CAMEL.sub(" ", name))]
    if any(w in APART for w in words):
        return "apart"
    return "main" if any(w in MAIN for w in words) else "none"


def features(page: Page) -> tuple[list[list[tuple]], list[tuple]]:
    """Per node: evidence of its own, and the kind of its edge to the parent."""
    n = len(page.tags)
    chars, linked, words = [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for k in range(n):
        up = page.parents[k]
        in_link[k] = page.tags[k] == "a" or (up >= 0 and in_link[up])
        if page.texts[k]:
            size = len("".join(page.texts[k].split()))
            chars[k], linked[k], words[k] = size, size * in_link[k], page.texts[k].count(" ")
    for k in range(n - 1, 0, -1):
        up = page.parents[k]
        chars[up] += chars[k]
        linked[up] += linked[k]
        words[up] += words[k]
    evidence, edges = [], []
    for k in range(n):
        tag = page.tags[k]
        stem = _stem(page.names[k]) if page.names[k] else "none"
        links = int(3 * linked[k] / chars[k] + 0.5) if chars[k] else -1
        if tag == "#text":
            # Text says little of its own: it follows its element.
            evidence.append([("words", (words[k] + 1).bit_length() // 2)])
        else:
            evidence.append([("tag", tag), ("stem", stem), ("links", links)])
        kind = "text" if tag == "#text" else "inline" if tag in INLINE else "block"
        if k and page.tags[page.parents[k]] in TOP:
            kind = f"top {kind}"
        edges.append((kind, stem, tag if tag in UNSEEN or "block" in kind else ""))
    return evidence, edges


@dataclass
class Model:
    """Log potentials: of evidence by state, of edges by parent's and own state."""

    evidence: dict[tuple, tuple[float, float]]
    edges: dict[tuple, tuple[tuple[float, float], tuple[float, float]]]

    @classmethod
    def fit(cls, pages: Iterable[tuple[Page, list[int]]]) -> Model:
        """From pages with the state of each node."""
        return cls.of_counts(count(pages))

    @classmethod
    def of_counts(cls, counts: tuple[Counter, Counter, Counter]) -> Model:
        """Shares of ``count``, smoothed by one."""
        seen, tied, states = counts
        evidence = {
            e: tuple(float(math.log((seen[e, s] + 1) / (states[s] + 2))) for s in (0, 1)) for e in {e for e, _ in seen}
        }
        edges = {}
        for key in {k for k, _, _ in tied}:
            rows = []
            for up in (0, 1):
                total = tied[key, up, 0] + tied[key, up, 1] + 2
                rows.append(tuple(float(math.log((tied[key, up, s] + 1) / total)) for s in (0, 1)))
            edges[key] = tuple(rows)
        return cls(evidence, edges)

    def marginals(self, page: Page) -> list[float]:
        """Probability of content for each node, by sum-product up and down the tree."""
        own, tied = self._potentials(page)
        n, parents = len(page.tags), page.parents
        off, on = [o[0] for o in own], [o[1] for o in own]
        sent = [(0.0, 0.0)] * n
        for k in range(n - 1, 0, -1):
            # To each state of the parent: over the own states.
            (aa, ab), (ba, bb) = tied[k]
            sent[k] = (_logsum(aa + off[k], ab + on[k]), _logsum(ba + off[k], bb + on[k]))
            off[parents[k]] += sent[k][0]
            on[parents[k]] += sent[k][1]
        for k in range(1, n):
            # From the parent, without what it heard from this node.
            (aa, ab), (ba, bb) = tied[k]
            up = parents[k]
            a, b = off[up] - sent[k][0], on[up] - sent[k][1]
            top = max(a, b)
            off[k] += _logsum(a - top + aa, b - top + ba)
            on[k] += _logsum(a - top + ab, b - top + bb)
        return [1.0 / (1.0 + math.exp(min(700.0, off[k] - on[k]))) for k in range(n)]

    def _potentials(self, page: Page) -> tuple[list, list]:
        evidence, edges = features(page)
        none = (0.0, 0.0)
        own = []
        # Nothing inside an element that is not rendered is content, whatever was learned.
        unseen = [False] * len(evidence)
        for k, found in enumerate(evidence):
            unseen[k] = page.tags[k] in UNSEEN or (k > 0 and unseen[page.parents[k]])
            seen = [self.evidence.get(e, none) for e in found]
            own.append((sum(x[0] for x in seen), _NEVER if unseen[k] else sum(x[1] for x in seen)))
        same = ((math.log(0.9), math.log(0.1)), (math.log(0.1), math.log(0.9)))
        tied = []
        for k, e in enumerate(edges):
            # What is not rendered says nothing about the element it stands in.
            found = ((0.0, 0.0), (0.0, 0.0)) if unseen[k] else self.edges.get(e)
            tied.append(found or next((self.edges[k] for k in _edge_keys(e)[1:] if k in self.edges), same))
        return own, tied


def count(pages: Iterable[tuple[Page, list[int]]]) -> tuple[Counter, Counter, Counter]:
    """How often evidence comes with a state, an edge with both its states, and a state."""
    seen, tied, states = Counter(), Counter(), Counter()
    for page, state in pages:
        for k, (evidence, edge) in enumerate(zip(*features(page), strict=True)):
            states[state[k]] += 1
            for e in evidence:
                seen[e, state[k]] += 1
            if k:
                for key in _edge_keys(edge):
                    tied[key, state[page.parents[k]], state[k]] += 1
    return seen, tied, states


def _logsum(a: float, b: float) -> float:
    return (a if a > b else b) + math.log1p(math.exp(-abs(a - b)))


def _edge_keys(edge: tuple) -> list[tuple]:
    """The edge itself, then ever coarser kinds for what was not seen in learning."""
    kind, stem, tag = edge
    return [(kind, stem, tag), (kind, stem), (kind,)]


def blocks(page: Page, content: list[float], least: float = 0.5) -> list[str]:
    """Text of the content nodes: white space is one blank, block elements set off blocks.

    A block element between two texts sets them apart even if nothing in it is content; what is not
    rendered (``UNSEEN``) does not.
    """
    block_of = [0] * len(page.tags)
    found, run, before = [], [], None
    for k, tag in enumerate(page.tags):
        up = page.parents[k]
        block = tag not in INLINE and tag not in VOID and tag not in UNSEEN
        block_of[k] = k if block else (block_of[up] if up >= 0 else 0)
        if block or tag == "hr":
            before = None
        if tag == "br" and run:
            run.append(" ")
        if tag != "#text" or content[k] <= least:
            continue
        if block_of[k] != before and run:
            found.append("".join(run))
            run = []
        run.append(page.texts[k])
        before = block_of[k]
    found.append("".join(run))
    joined = (" ".join(b.split()) for b in found)
    return [b for b in joined if b]


def extract(html: str | None, model: Model) -> str:
    page = parse(html or "")
    return "\n\n".join(blocks(page, model.marginals(page)))


def _states(page: Page, own) -> list[int]:
    """States from ``own(page, node)``: 0, 1, or None to follow the parent."""
    states: list[int] = []
    for k in range(len(page.tags)):
        said = own(page, k)
        states.append(said if said is not None else states[page.parents[k]] if k else 0)
    return states


def by_attribute(page: Page) -> list[int]:
    """Labels of pages that carry them in ``data-label``: content or other."""
    told = {"content": 1, "other": 0}
    return _states(page, lambda p, k: 0 if p.tags[k] in UNSEEN else told.get(p.labels[k] or ""))


def by_landmark(page: Page) -> list[int] | None:
    """Labels by the landmark elements of HTML, or None for a page without an article."""
    marks = {"article": 1, "main": 1, "nav": 0, "aside": 0, "header": 0, "footer": 0, "form": 0}
    if not {"article", "main"} & set(page.tags):
        return None

    def own(p: Page, k: int):
        if p.tags[k] in UNSEEN or (p.names[k] and _stem(p.names[k]) == "apart"):
            return 0
        return marks.get(p.tags[k])

    return _states(page, own)


def written_pages() -> list[str]:
    """Labelled pages of common layouts, made by rule: containers by name or landmark, and what stands around them."""
    line = "This is a sentence of some length that goes on for a while and then ends."
    mains = [("article", ""), ("main", ""), ("div", "content"), ("div", "post"), ("section", "story"), ("div", "entry-content"), ("div", ""), ("", "")]
    asides = [("nav", ""), ("header", ""), ("footer", ""), ("aside", ""), ("form", "")]
    asides += [("div", name) for name in APART] + [("section", "comments"), ("ul", "menu"), ("p", "notice"), ("div", "")]
    told = ' data-label="content"'
    parts = [
        f"<h1{told}>{line}</h1>",
        f"<p{told}>{line} {line}</p>",
        f'<p{told}><b>{line}</b> <a href="x">word</a> {line}</p>',
        f"<h2{told}>Title</h2>",
        f"<ul{told}><li>{line}</li><li>{line}</li></ul>",
        f"<blockquote{told}><p>{line}</p></blockquote>",
        f"<table{told}><tr><td>{line}</td></tr></table>",
        f"<pre{told}>{line}</pre>",
    ]
    inner = "".join(parts)
    pages = []
    for k, ((tag, name), (other, aside)) in enumerate(product(mains, asides)):
        within = k % 3 == 0 and (aside != "" or other != "div") and tag != ""
        links = "<ul>" + "".join(f'<li><a href="/{i}">Word {i}</a></li>' for i in range(4)) + "</ul>"
        kinds = (f"<p>{line}</p>", links, f"<h3>Title</h3><p>{line}</p>", f"<h1>Title</h1><p>{line}</p>", line)
        plain = kinds[k % len(kinds)]
        if other == "div" and not aside:
            plain = links
        if other == "form":
            plain = f"<label>Name</label><input><p>{line}</p>"
        if aside in ("comments", "respond", "replies"):
            plain = f"<h3>Title</h3><article><p>{line}</p></article><article><p>{line} {line}</p></article>"
        part = f'<{other} class="{aside}" data-label="other">{plain}</{other}>'
        body = f'<{tag} class="{name}" data-label="content">{part if within else ""}{inner}</{tag}>' if tag else inner
        pages.append(f"<html><head><title>{line}</title></head><body>{'' if within else part}{body}<footer>{line}</footer></body></html>")
    return pages


def learn(pages: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from ``written_pages`` and about ``sample`` rows ``(id, html)`` that have landmarks.

    The rows are chosen by a hash of their id and page. They are counted in the tasks;
    the driver gets counts by kind of element, not pages.
    """
    total = pages.count()
    part = F.pmod(F.xxhash64(F.lit(13), "id", "html"), F.lit(1 << 30)) / (1 << 30)
    chosen = pages.where(part < min(1.0, sample / max(total, 1))).select("html")

    def tally(batches):
        for batch in batches:
            parsed = (parse(h.as_py() or "") for h in batch.column(0))
            counts = count((p, states) for p in parsed if (states := by_landmark(p)))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(counts)], pa.binary())], ["counts"])

    written = [(p, by_attribute(p)) for p in map(parse, written_pages())] * WRITTEN
    sums = count(written)
    for row in chosen.mapInArrow(tally, "counts binary").collect():
        for into, more in zip(sums, pickle.loads(row["counts"]), strict=True):
            into.update(more)
    return Model.of_counts(sums)


def main_text(pages: DataFrame, model: Model, html: str = "html") -> DataFrame:
    """``pages`` without the html, with ``text`` and ``n_chars``; rows depend on their page alone.

    NULL and empty pages, and pages without content, have an empty text. Columns of ``pages`` that
    are named like the two new ones give way to them.
    """
    rest = [c for c in pages.columns if c.lower() not in (html.lower(), "text", "n_chars")]

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            texts = [extract(h.as_py(), model) for h in batch.column(names.index(html))]
            columns = [batch.column(names.index(c)) for c in rest]
            columns += [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*rest, "text", "n_chars"])

    schema = pages.select(*rest).schema.add("text", "string").add("n_chars", "long")
    return pages.select(*rest, html).mapInArrow(run, schema)
