"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read tolerantly into leaf blocks: runs of text between block-level tags, with
the open elements around them.  The field labels each block main or other, from ancestor
tags and class words and from the text, decoded by Viterbi; neighbours weigh in through
its transitions.  It is trained on pages made by `training_pages`, which know their labels.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passledger.llm.common import others, text_blocks
from passledger.llm.crf import Crf, slot, train

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body br button canvas caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html iframe label legend li link main menu meta nav noscript ol optgroup option p pre search section select summary table tbody td template textarea tfoot th thead title tr ul".split())
_INLINE = frozenset("a abbr b big cite code em font i mark q s small span strike strong sub sup tt u".split())
_OUTER = frozenset("nav header footer aside form head".split())
#: Their content is markup or code, never text.
_SILENT = frozenset("script style template noembed noframes iframe".split())
#: Foreign and embedded content; without an end tag only the start tag is passed over.
_FOREIGN = re.compile(r"<(/?)(svg|math|object)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>", re.I)
#: A start tag that closes the nearest open one of these, unless one of the stops is nearer.
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
_CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre search section summary table ul".split())
_P_STOPS = frozenset("table td th button object body".split())
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_NAMED = re.compile(r"(?:^|[\s/\"'])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Open:
    """An open element, as the blocks in it see it.

    It holds only what it adds to the elements around it, so that deep pages cost no more than
    flat ones: `new` are the features of its tag and names that these lack, `inner` the innermost
    tag that is not inline, its names and the tag around that one.
    """

    __slots__ = ("parent", "tag", "words", "new", "inner", "linked", "outer", "main", "score")

    def __init__(self, parent: Open | None = None, tag: str = "", words: tuple[str, ...] = (), new: tuple[str, ...] = ()):
        solid = parent is not None and tag not in _INLINE
        self.parent, self.tag, self.words, self.new = parent, tag, words, new
        self.inner: tuple[str, tuple[str, ...], str] = (tag, words, parent.inner[0]) if solid else parent.inner if parent else ("", (), "")
        self.linked = tag == "a" or (parent is not None and parent.linked)
        self.outer = tag in _OUTER or (parent is not None and parent.outer)
        self.main = tag in ("article", "main") or (parent is not None and parent.main)
        self.score: float | None = None


class _Elements:
    """The open elements of a page, with the places of each tag."""

    def __init__(self):
        self.stack = [Open()]
        self.places: dict[str, list[int]] = {}
        self.seen: set[str] = set()

    @property
    def top(self) -> Open:
        return self.stack[-1]

    def open(self, tag: str, words: tuple[str, ...]) -> None:
        features = [] if tag in _INLINE else ["tag=" + tag]
        features += ["word=" + w for w in words]
        new = tuple(x for x in dict.fromkeys(features) if x not in self.seen)
        self.seen.update(new)
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append(Open(self.top, tag, words, new))

    def _nearest(self, tags: Iterable[str]) -> int:
        """Place of the innermost open one of `tags`, 0 if none is open."""
        at = 0
        for tag in tags:
            own = self.places.get(tag)
            if own and own[-1] > at:
                at = own[-1]
        return at

    def close(self, names: Iterable[str], stops: Iterable[str] = ()) -> None:
        """Closes the nearest open one of `names` and all in it, unless one of `stops` is nearer."""
        at = self._nearest(names)
        if not at or at < self._nearest(stops):
            return
        for gone in reversed(self.stack[at:]):
            self.places[gone.tag].pop()
            for x in gone.new:
                self.seen.remove(x)
        del self.stack[at:]


@dataclass(frozen=True)
class Block:
    """A leaf block: the innermost element open around it, and its text."""

    path: Open
    text: str
    linked: float


def _foreign_ends(page: str) -> dict[int, int]:
    """Where foreign elements start, and the end of the end tag of the same nesting."""
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for m in _FOREIGN.finditer(page):
        own = opened.setdefault(m[2].lower(), [])
        if not m[1] and not m[0].endswith("/>"):
            own.append(m.start())
        elif m[1] and own:
            ends[own.pop()] = m.end()
    return ends


def blocks_of(page: str | None) -> list[Block]:
    """Leaf blocks of a page with text, in page order."""
    out: list[Block] = []
    around = _Elements()
    pieces: list[str] = []
    linked = 0
    at = 0
    page = page or ""
    foreign_ends: dict[int, int] | None = None

    def flush():
        nonlocal linked
        if pieces:
            raw = "".join(pieces)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                out.append(Block(around.top, text, min(1.0, linked / max(1, len(raw.strip())))))
            pieces.clear()
        linked = 0

    def say(text: str):
        nonlocal linked
        if text:
            pieces.append(text)
            if around.top.linked:
                linked += len(text.strip())

    while True:
        m = _TAG.search(page, at)
        say(page[at : m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        if m[1] is not None:
            say(m[1])
        if m[3] is None:
            continue
        tag = m[3].lower()
        if tag in _BLOCK or tag in _SILENT or tag == "svg":
            flush()
        if m[2]:
            around.close((tag,))
            continue
        if tag in _SILENT:
            if not m[4].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in ("svg", "math", "object"):
            foreign_ends = _foreign_ends(page) if foreign_ends is None else foreign_ends
            if m.start() not in foreign_ends:
                continue
            if tag == "svg":
                at = foreign_ends[m.start()]
                continue
        if tag in _CLOSES:
            around.close(*_CLOSES[tag])
        if tag in _CLOSES_P:
            around.close(("p",), _P_STOPS)
        if tag == "body":
            around.close(("head",))
        if tag not in _VOID:
            around.open(tag, tuple(x.lower() for n in _NAMED.findall(m[4]) for x in _PART.findall("".join(n))) if m[4] else ())
    flush()
    return out


# ---- features

_SLOTS = 1 << 15


def own_features(element: Open) -> list[str]:
    """What blocks right in an element have beside the `new` features of all elements around them."""
    tag, words, outside = element.inner
    names = [f"inner={tag}", f"pair={tag},{outside}", *[f"named={tag},{w}" for w in words]]
    if not element.outer:
        names.append("tag=none of the outer ones")
    if element.main:
        names.append("tag=article or main")
    return names


def path_features(element: Open) -> list[int]:
    """Ancestor tags and class words, the innermost block tag and its parent."""
    names, at = own_features(element), element
    while at is not None:
        names.extend(at.new)
        at = at.parent
    return [slot(x, _SLOTS) for x in names]


def text_features(block: Block) -> list[str]:
    n = len(block.text)
    marks = sum(block.text.count(c) for c in ".,;:!?")
    return [
        f"length={sum(n > x for x in (10, 25, 60, 120, 300))}",
        f"linked={sum(block.linked > x for x in (0.05, 0.5, 0.9))}",
        f"ends={block.text[-1] in '.!?:;…”»'}",
        f"marks={min(3, marks)}",
        f"sign={'©' in block.text}",
    ]


def block_rows(blocks: list[Block]) -> list[list[int]]:
    return [path_features(b.path) + [slot(x, _SLOTS) for x in text_features(b)] for b in blocks]


# ---- labelled pages


class _Maker:
    """Pages with labels: each leaf block's text starts with a mark that says whether it is main."""

    MAIN, OTHER = "①", "②"

    def __init__(self, r: random.Random):
        self.r = r

    def words(self, low: int, high: int) -> str:
        r = self.r
        made = ["".join(r.choice(("th", "en", "on", "la", "ich", "er", "ti", "que", "os", "ne", "a", "ó", "ü", "re", "st")) for _ in range(r.randint(1, 4))) for _ in range(r.randint(low, high))]
        return " ".join(made).capitalize()

    def text(self, main: bool, low: int = 1, high: int = 60) -> str:
        r = self.r
        body = self.words(low, high)
        if high > 8 and r.random() < 0.7:
            body += r.choice((".", ".", "!", "?"))
        if r.random() < 0.15:
            body = body.replace(" ", r.choice((" <b>", " <i>", ' <a href="/x">')), 1)
        return (self.MAIN if main else self.OTHER) + body

    def link(self) -> str:
        return f'<a href="/{self.r.randint(1, 99)}">{self.text(False, 1, 4)}</a>'

    def article(self) -> str:
        r, out = self.r, []
        if r.random() < 0.8:
            out.append(f"<h1>{self.text(True, 2, 10)}</h1>")
        for _ in range(r.choice((1, 1, 2, 3, 4, 6, 9, 14))):
            kind = r.random()
            if kind < 0.62:
                out.append(f"<p>{self.text(True, 1, r.choice((3, 12, 60, 120)))}</p>")
            elif kind < 0.70:
                out.append(f"<p><b>{self.text(True, 1, r.choice((3, 12, 60)))}<br>")
            elif kind < 0.76:
                out.append(f"<{(h := r.choice(('h2', 'h3')))}>{self.text(True, 1, 8)}</{h}>")
            elif kind < 0.82:
                out.append("<{0}>{1}</{0}>".format(r.choice(("ul", "ol")), "".join(f"<li>{self.text(True, 1, 15)}</li>" for _ in range(r.randint(1, 5)))))
            elif kind < 0.86:
                out.append(f"<blockquote><p>{self.text(True, 3, 40)}</p></blockquote>")
            elif kind < 0.89:
                out.append(f"<pre>{self.text(True, 3, 20)}</pre>")
            elif kind < 0.91:
                out.append("<table><tr>" + "".join(f"<td>{self.text(True, 1, 4)}</td>" for _ in range(3)) + "</tr></table>")
            elif kind < 0.93:
                out.append(f"<figure><img src=x><figcaption>{self.text(True, 2, 12)}</figcaption></figure>")
            elif kind < 0.97:
                out.append(self.other(inside=True))
            else:
                out.append(f"<div>{self.text(True, 2, 50)}</div>")
        return "".join(out)

    def other(self, inside: bool = False) -> str:
        r = self.r
        menu = lambda: "<ul>" + "".join(f"<li>{self.link()}</li>" for _ in range(r.randint(2, 8))) + "</ul>"
        prose = lambda: r.choice((lambda: self.text(False, 1, r.choice((4, 15, 50))), lambda: f"<p>{self.text(False, 1, r.choice((4, 15, 50)))}</p>", lambda: f"<h3>{self.text(False, 1, 5)}</h3><p>{self.text(False, 1, 40)}</p>"))()
        named = lambda names, body: "<{0} {1}=\"{2}\">{3}</{0}>".format(r.choice(("div", "div", "section", "aside", "p", "span") if "<" not in body else ("div", "div", "section", "aside")), r.choice(("class", "class", "id")), r.choice(names), body)
        kinds = [
            lambda: named(("ad", "ads", "ad-box", "advert", "advertisement", "sponsored", "promo", "banner", "banner-ad", "top-ad"), prose()),
            lambda: named(("share", "social", "share-buttons", "related", "related-posts", "more-links", "recommended", "tags", "read-more"), r.choice((menu, prose))()),
            lambda: named(("newsletter", "subscribe", "signup", "login", "search-form"), f"<form>{self.text(False, 1, 15)}<label>{self.text(False, 1, 4)}</label><button>{self.text(False, 1, 2)}</button></form>"),
            lambda: named(("notice", "cookie", "cookie-notice", "cookie-banner", "consent", "alert", "popup", "modal", "gdpr", "disclaimer", "warning", "paywall"), prose()),
            lambda: named(("comments", "comment-list", "comment", "comment-body", "reader-comments", "discussion", "replies", "disqus", "user-comments"), "".join(r.choice((f"<div class=comment><p>{self.text(False, 1, 50)}</p></div>", f"<ol><li>{self.text(False, 1, 40)}</li></ol>", f"<article class=comment><p>{self.text(False, 1, 40)}</p></article>", f"<h2>{self.text(False, 1, 3)}</h2><p>{self.text(False, 1, 50)}</p>")) for _ in range(r.randint(1, 4)))),
            lambda: f"<aside>{prose()}{menu() if r.random() < 0.4 else ''}</aside>",
            lambda: f"<form action=/s>{self.text(False, 1, 12)}<select><option>{self.text(False, 1, 2)}<option>{self.text(False, 1, 2)}</select><textarea>{self.text(False, 1, 9)}</textarea><button>{self.text(False, 1, 2)}</button></form>",
        ]
        if not inside:
            kinds += [
                lambda: f"<nav>{menu()}</nav>",
                lambda: f"<header>{r.choice((lambda: f'<h1>{self.text(False, 1, 4)}</h1>', lambda: prose(), lambda: menu()))()}</header>",
                lambda: f"<footer>{r.choice((lambda: '&copy; ' + self.text(False, 1, 20), lambda: prose(), lambda: menu()))()}</footer>",
                lambda: named(("menu", "nav", "navbar", "top-menu", "main-nav", "breadcrumbs", "breadcrumb", "pagination", "skip-link"), r.choice((menu, lambda: " &gt; ".join(self.link() for _ in range(3))))()),
                lambda: named(("sidebar", "side-bar", "widget", "left-column", "rail", "secondary"), r.choice((menu, prose))()),
                lambda: named(("header", "site-header", "masthead", "top-bar", "logo", "site-title", "page-header", "branding"), prose()),
                lambda: named(("footer", "site-footer", "copyright", "bottom", "legal", "page-footer", "colophon"), prose()),
                lambda: f"<noscript>{self.text(False, 2, 10)}</noscript>",
            ]
        return r.choice(kinds)()

    def page(self) -> str:
        r = self.r
        if r.random() < 0.02:
            return self.text(True, 3, 60)
        tag, name = r.choice((("article", ""), ("article", ""), ("article", "post"), ("main", ""), ("main", "content"), ("div", "content"), ("div", "main-content"), ("div", "post"), ("div", "post-content"), ("div", "entry-content"), ("div", "article-body"), ("div", "article"), ("div", "story"), ("section", "article-text"), ("section", "body-text"), ("div", "")))
        before = "".join(self.other() for _ in range(r.choice((0, 1, 2, 3, 4, 6))))
        after = "".join(self.other() for _ in range(r.choice((0, 1, 2, 3, 4, 6))))
        body = f"<{tag}{f' class={chr(34)}{name}{chr(34)}' if name else ''}>{self.article()}</{tag}>"
        if r.random() < 0.3:
            body = r.choice((f"<main>{body}{self.other()}</main>", f'<div class="wrapper"><div class="container">{body}</div></div>', f'<div id="page">{self.other()}{body}</div>'))
        head = f"<head><meta charset=utf-8><title>{self.text(False, 1, 10)}</title><style>p{{}}</style><script>var a='<p>';</script></head>" if r.random() < 0.9 else ""
        return f"<!DOCTYPE html><html>{head}<body>{before}{body}{after}{'</body></html>' if r.random() < 0.9 else ''}"


def training_pages(n: int = 1800, seed: int = 23) -> Iterator[tuple[list[Block], list[int]]]:
    """Blocks of made pages, and for each whether it is main text."""
    maker = _Maker(random.Random(seed))
    for _ in range(n):
        blocks, labels = [], []
        for b in blocks_of(maker.page()):
            labels.append(int(maker.MAIN in b.text))
            blocks.append(Block(b.path, b.text.replace(maker.MAIN, "").replace(maker.OTHER, "").strip() or "x", b.linked))
        yield blocks, labels


def fit(n: int = 1800, width: int = 32, epochs: int = 12) -> Crf:
    rows, labels = [], []
    pages = [(block_rows(blocks), ys) for blocks, ys in training_pages(n)]
    most = max((len(features) for made, _ in pages for features in made), default=1)
    for made, ys in pages:
        for at in range(0, len(made), width):
            own, y = np.zeros((width, most), np.int32), np.full(width, -1)
            for i, (features, label) in enumerate(zip(made[at : at + width], ys[at : at + width])):
                own[i, : len(features)], y[i] = features, label
            rows.append(own)
            labels.append(y)
    return train(np.stack(rows), np.array(labels), _SLOTS, 2, epochs=epochs, batch=64)


class Extractor:
    """Main text of pages with a fitted field."""

    def __init__(self, crf: Crf):
        self.crf = crf
        lead = crf.weights[:, 1] - crf.weights[:, 0]
        self._lead = lead
        self._known: dict[tuple, float] = {}

    def _sum(self, key: tuple, names: Callable[[], Iterable[str]]) -> float:
        """Sum of the weights of the features that `key` stands for."""
        known = self._known.get(key)
        if known is None:
            if len(self._known) > 100_000:
                self._known.clear()
            self._known[key] = known = sum(float(self._lead[slot(x, _SLOTS)]) for x in names())
        return known

    def _around(self, element: Open) -> float:
        """Score of the `new` features of an element and all around it; kept with each of them."""
        chain = []
        while element is not None and element.score is None:
            chain.append(element)
            element = element.parent
        total = 0.0 if element is None else element.score
        for own in reversed(chain):
            if own.new:
                total += self._sum(own.new, lambda: own.new)
            own.score = total
        return total

    def _score(self, block: Block) -> float:
        at = block.path
        own = self._sum((at.inner, at.outer, at.main), lambda: own_features(at))
        texts = tuple(text_features(block))
        return self._around(at) + own + self._sum(texts, lambda: texts)

    def labels(self, blocks: list[Block]) -> list[int]:
        """Viterbi on the scores' difference: main (1) or other (0)."""
        (s00, s01), (s10, s11) = self.crf.steps.tolist()
        zero, one = self.crf.first.tolist()
        back = []
        for i, b in enumerate(blocks):
            if i:
                from0, from1 = (zero + s00 >= one + s10), (zero + s01 >= one + s11)
                back.append((0 if from0 else 1, 0 if from1 else 1))
                zero, one = max(zero + s00, one + s10), max(zero + s01, one + s11)
            one += self._score(b)
        last = self.crf.last.tolist()
        path = [int(one + last[1] > zero + last[0])] if blocks else []
        for step in reversed(back):
            path.append(step[path[-1]])
        return path[::-1]

    def text(self, page: str | None) -> str:
        """Main blocks joined by newlines; empty if there are none."""
        blocks = blocks_of(page)
        return "\n".join(b.text for b, y in zip(blocks, self.labels(blocks)) if y)


_EXTRACTORS: dict[int, Extractor] = {}


def _extracted(shared, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = shared.value
        if id(crf) not in _EXTRACTORS:
            _EXTRACTORS.clear()
            _EXTRACTORS[id(crf)] = Extractor(crf)
        extractor = _EXTRACTORS[id(crf)]
        for batch in text_blocks(batches, "html"):
            texts = [extractor.text(p) for p in batch.column("html").to_pylist()]
            columns = {"rest": batch.column("rest"), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}
            yield pa.RecordBatch.from_arrays([columns[n].cast(schema.field(n).type) for n in schema.names], schema=schema)

    return run


def extract_text(pages: DataFrame, crf: Crf, html_col: str = "html") -> DataFrame:
    """`pages` without `html_col`, with `_text` string and `_n_chars` long (code points).

    The whole page counts; null, empty and textless pages give an empty text.  Rows are
    extracted one by one; an empty table gives an empty result.  Input columns `_text` and
    `_n_chars` give way to the result.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    keep = [c for c in others(pages, "_text", "_n_chars") if c != html_col]
    rest = (F.struct(*[pages[f"`{c}`"] for c in keep]) if keep else F.struct(F.lit(0).alias("_"))).alias("rest")
    df = pages.select(rest, pages[f"`{html_col}`"].cast("string").alias("html"))
    schema = StructType([df.schema["rest"], *StructType.fromDDL("text string, n_chars long").fields])
    shared = df.sparkSession.sparkContext.broadcast(crf)
    out = df.mapInArrow(_extracted(shared, to_arrow_schema(schema)), schema)
    return out.select(*[F.col(f"rest.`{c}`") for c in keep], F.col("text").alias("_text"), F.col("n_chars").alias("_n_chars"))
