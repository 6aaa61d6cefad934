"""Main text of web pages through wrappers inferred from pages of the same host.

A page is read leniently into blocks: elements that break a line, and the runs of text between them.
Its token stream is generalised to a union-free regular expression, and the expressions of a host's pages
are aligned one after the other: tokens that agree stay, texts that differ become text slots, tokens
that one side lacks become optional groups, and neighbours that repeat become repeated groups. The
result, a host's wrapper, accepts all of its pages and knows which slots hold the same text on every page:
those belong to the template.

A page's main text is what its articles hold (else its main or content elements, else its body), in page order
and with the last ``h1`` before them if they have none, without
elements that are menus, headers, footers, sidebars, notices, adverts, forms, reader comments and the
like by name, role or class. A class counts by its last word without where it stands (``sidebar-left``, but not
``with-sidebar`` or ``share-prices``), and not at all on an element that holds the page's only articles. Of nested
holders the outer one is taken if most of the text that is not the template's lies outside the inner ones.
Of a page without a holder, template slots of the wrapper go too, and lists that are the same on
every page; an article is kept whole, as its headings and paragraphs may be the same on many pages. On the
generated tables every page has an article, and the wrapper changes no page there.

Wrappers are merged in the task that reads the pages, and again over tasks, one row per host and task;
merging is commutative up to the order of options, and a wrapper's size follows the variety of the markup,
not the number of pages. The wrappers are written to the shared folder, so the join knows their size: small tables
are broadcast and pages stay where they are read, larger ones meet in an equi-join that adaptive execution can split.

Defined cases: null or empty markup gives the empty text; a null address belongs to the host ``''``; a host
with fewer than ``TEMPLATE_PAGES`` different pages has no template slots; repeated pages give a row each.
"""
from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TEMPLATE_PAGES = 4
DEEPEST = 40
LONGEST = 48
HOSTS_PER_FLUSH = 2000

SPACE = re.compile(r"\s+")
HOST = re.compile(r"^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]*)", re.I)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|template|noscript|textarea|svg|iframe|title|select|object|math)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+)/?>"
    r"|<[!?/a-zA-Z][^>]*(?:>|\Z)", re.S | re.I)
#: One attribute after the other, so that nothing inside a name or a quoted value is taken for one.
ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Elements inside a line; all others break it (fixed values of HTML).
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements closed by the next of their kind.
IMPLIED = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
AROUND = frozenset("nav footer aside form button dialog menu head".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus gdpr menu modal nav navbar "
    "navigation newsletter notice notices pager pagination popup promo related replies reply respond share sharing sidebar sidebars social sponsor sponsored subscribe "
    "teaser teasers toolbar widget widgets footer".split())
#: Words behind a hint that say where or how it stands (a sidebar-left is a sidebar, a share-price is no share).
PLACES = frozenset(
    "left right top bottom main primary secondary outer inner wrapper wrap container box area block section list bar item items link links button buttons form "
    "post posts article articles story stories head title unit slot holder group row column col".split())
#: Words that say what an element has, or lacks, beside its own text.
HAVING = frozenset("with without has no hide hidden is".split())
OUTSIDE_ARTICLE = frozenset("header masthead".split())
BODY_HINTS = frozenset("article content post story entry".split())
WORDS_OF_CLASS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Page:
    """``texts``: blocks in page order; ``around``: whether each is outside the main text by its elements;
    ``holder``: the article-like element of each (kind, number); ``title``: whether each is an ``h1``;
    ``tree``: the page's expression."""

    def __init__(self, markup: str):
        self._void: frozenset[int] = frozenset()  # elements whose class does not count
        self._start()
        self._read(markup)
        if self._hinted and not any(h[0] >= 3 and not a for h, a in zip(self.holder, self.around, strict=True)):
            self._void = frozenset(self._hinted)  # all articles stand in elements that their class calls a sidebar or the like
            self._start()
            self._read(markup)

    def _start(self) -> None:
        self._hinted: set[int] = set()  # elements, by where they begin, that only their class puts around the main text and that hold an article
        self.texts: list[str] = []
        self.around: list[bool] = []
        self.holder: list[tuple[int, int]] = []
        self.title: list[bool] = []
        self.tree: list[dict] = []

    def _read(self, markup: str) -> None:
        stack: list[tuple[str, bool, tuple[int, int], list, int]] = [("", False, (0, 0), self.tree, -1)]
        parts: list[str] = []
        numbers = at = 0

        def close_block() -> None:
            text = SPACE.sub(" ", entities.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                name, around, holder, children, _ = stack[-1]
                children.append({"t": "#", "v": zlib.crc32(text.encode("utf-8", "surrogatepass")), "i": [len(self.texts)]})
                self.texts.append(text)
                self.around.append(around)
                self.holder.append(holder)
                self.title.append(name == "h1")

        for m in TOKEN.finditer(markup):
            if m.start() > at:
                parts.append(markup[at: m.start()])
            at = m.end()
            name = (m["name"] or "").lower()
            if not name:
                if m["raw"]:
                    parts.append(" ")
                continue
            attrs = self._attributes(m["attrs"]) if not m["close"] else {}
            if name in INLINE and not (attrs.keys() & {"class", "id", "role"} and self._hint(name, attrs, False)):
                if name == "br":
                    parts.append(" ")
                if not m["close"] or all(s[0] != name for s in stack[1:]):
                    continue
            close_block()
            if m["close"]:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        break
                continue
            while len(stack) > 1 and stack[-1][0] in IMPLIED.get(name, ()):
                stack.pop()
            if name in EMPTY:
                continue
            _, around, holder, children, _ = stack[-1]
            hint = self._hint(name, attrs, holder[0] >= 3)
            by_class = hint and not self._hint(name, {k: v for k, v in attrs.items() if k == "role"}, holder[0] >= 3)
            if hint and m.start() in self._void:
                hint = False
            if name in ("article", "main") and not hint and "hidden" not in attrs and not self._void:
                self._hinted.update(s[4] for s in stack if s[4] >= 0)
            around = around or "hidden" in attrs or hint
            words = self._words(attrs)
            kind = (1 if name == "body" else 0 if name == "html" else 4 if name == "article" else 3 if name == "main" or attrs.get("role") == "main"
                    else 2 if words & BODY_HINTS else 0)
            if kind > holder[0] and not around:
                numbers += 1
                holder = (kind, numbers)
            label = name + "".join(sorted("." + w for w in (attrs.get("class") or "").split()[:1]))
            inner: list = []
            if len(stack) < DEEPEST:
                children.append({"t": label, "c": inner})
            else:
                inner = children
            stack.append((name, around, holder, inner, m.start() if by_class and name not in ("article", "main") else -1))
        parts.append(markup[at:])
        close_block()

    @staticmethod
    def _attributes(raw: str | None) -> dict[str, str]:
        out: dict[str, str] = {}
        for name, *values in ATTRIBUTE.findall(raw or ""):
            out.setdefault(name.lower(), next((v for v in values if v), ""))
        return out

    @staticmethod
    def _named(attrs: dict) -> set[str]:
        """What the classes and the id call the element: the last word of each name, without where it stands."""
        out = set()
        for token in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
            words = [w.lower() for w in WORDS_OF_CLASS.findall(token)]
            if words and words[0] in HAVING:
                continue
            while len(words) > 1 and words[-1] in PLACES:
                words.pop()
            out.update(words[-1:])
        return out

    @staticmethod
    def _words(attrs: dict) -> set[str]:
        return {w.lower() for k in ("class", "id") for w in WORDS_OF_CLASS.findall(attrs.get(k) or "")}

    @classmethod
    def _hint(cls, name: str, attrs: dict, inside: bool) -> bool:
        if name in AROUND or (attrs.get("role") or "").lower() in ROLES:
            return True
        named = cls._named(attrs)
        if name in ("article", "main", "body", "html"):
            return name == "article" and bool(named & {"comment", "comments", "teaser", "related", "ad", "ads", "reply"})
        return bool(named & HINTS) or not inside and (name in OUTSIDE_ARTICLE or bool(named & OUTSIDE_ARTICLE))


def _said(*parts: int | None) -> int | None:
    """One number for a sequence of texts; None if one of them varies."""
    return None if None in parts else zlib.crc32(repr(parts).encode())


def generalise(nodes: list[dict]) -> list[dict]:
    """Repeated neighbours become one repeated group, which knows what its texts say (``s``) on the page; of long mixed lists,
    all of a label do."""
    out: list[dict] = []
    for n in nodes:
        if n["t"] == "#":
            n = n | {"s": n["v"]}
        else:
            inner = generalise(n["c"])
            n = n | {"c": inner, "s": _said(*(c["s"] for c in inner))}
        if out and out[-1]["t"] == n["t"]:
            out[-1] = merge_node(out[-1], n) | {"r": 1, "s": _said(out[-1]["s"], n["s"]), "m": 1}
        else:
            out.append(n)
    if len(out) > LONGEST:
        by: dict[str, dict] = {}
        for n in out:
            by[n["t"]] = merge_node(by[n["t"]], n) | {"r": 1, "s": _said(by[n["t"]]["s"], n["s"]), "m": 1} if n["t"] in by else n
        out = list(by.values())
    return out


def pairs(a: list[dict], b: list[dict]) -> list[tuple[int | None, int | None]]:
    """Alignment of two expressions: longest common subsequence of their labels."""
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i]["t"] == b[j]["t"] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i]["t"] == b[j]["t"]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            out.append((i, None))
            i += 1
        else:
            out.append((None, j))
            j += 1
    return out


def merge_node(a: dict, b: dict) -> dict:
    out = {"t": a["t"]}
    if a["t"] == "#":
        out["v"] = a.get("v") if a.get("v") == b.get("v") else None
        out["n"] = a.get("n", 1) + b.get("n", 1)
        if "i" in a or "i" in b:
            out["i"] = a.get("i", []) + b.get("i", [])
    else:
        out["c"] = merge(a["c"], b["c"])
    for flag in "ro":
        if a.get(flag) or b.get(flag):
            out[flag] = 1
    out["s"] = a.get("s") if a.get("s") == b.get("s") else None
    out["m"] = a.get("m", 1) + b.get("m", 1)
    return out


def merge(a: list[dict], b: list[dict]) -> list[dict]:
    """One expression for what either accepts."""
    out = []
    for i, j in pairs(a, b):
        out.append(merge_node(a[i], b[j]) if i is not None and j is not None else (a[i] if j is None else b[j]) | {"o": 1})
    return _folded(out)


def _folded(nodes: list[dict]) -> list[dict]:
    out: list[dict] = []
    for n in nodes:
        if out and out[-1]["t"] == n["t"]:
            out[-1] = merge_node(out[-1], n) | {"r": 1, "s": None}
        else:
            out.append(n)
    if len(out) > LONGEST:
        by: dict[str, dict] = {}
        for n in out:
            by[n["t"]] = merge_node(by[n["t"]], n) | {"r": 1, "s": None} if n["t"] in by else n
        out = list(by.values())
    return out


def expression(nodes: list[dict]) -> str:
    """The wrapper as a regular expression over tags and ``#``."""
    out = []
    for n in nodes:
        x = "#" if n["t"] == "#" else f"<{n['t']}>{expression(n['c'])}</{n['t'].partition('.')[0]}>"
        out.append(f"({x}){'*' if n.get('o') and n.get('r') else '+' if n.get('r') else '?'}" if n.get("o") or n.get("r") else x)
    return "".join(out)


def bare(nodes: list[dict]) -> list[dict]:
    """Without the places of one page's texts."""
    return [({k: v for k, v in n.items() if k != "i"} | ({"c": bare(n["c"])} if "c" in n else {"n": n.get("n", 1)})) for n in nodes]


def places(nodes: list[dict]) -> set[int]:
    """All texts of an expression."""
    out: set[int] = set()
    for n in nodes:
        out.update(n.get("i", []))
        out |= places(n.get("c", []))
    return out


def template_texts(wrapper: list[dict], page: list[dict]) -> set[int]:
    """Texts of the page that stand in a slot, or a repeated group, with the same text on every page. If that is all of the
    page, it tells nothing: then none."""
    out = _template(wrapper, page)
    return set() if out == places(page) else out


def _template(wrapper: list[dict], page: list[dict]) -> set[int]:
    out: set[int] = set()
    for i, j in pairs(wrapper, page):
        if i is None or j is None:
            continue
        w, p = wrapper[i], page[j]
        if w.get("r") and not w.get("o") and w.get("s") is not None and w["s"] == p.get("s") and w.get("m", 1) >= TEMPLATE_PAGES:
            out |= places([p])
        elif w["t"] == "#":
            if w.get("v") is not None and w.get("v") == p.get("v") and w.get("n", 1) >= TEMPLATE_PAGES and not w.get("r"):
                out.update(p.get("i", []))
        else:
            out |= _template(w["c"], p["c"])
    return out


def host_of(url: str | None) -> str:
    m = HOST.match(url or "")
    return m[1].lower() if m else ""


def main_text(page: Page, template: set[int]) -> str:
    """The blocks of the page's holders: of articles, unless most of the text that is not the template's stands around them in a main
    or content element; then of these too."""
    inside = [i for i in range(len(page.texts)) if not page.around[i]]
    kind = max((page.holder[i][0] for i in inside), default=0)
    if kind >= 2:
        own = [0] * 5  # words in holders of a kind or a better one, without titles and what is the template's
        for i in inside:
            for k in range(2, page.holder[i][0] + 1):
                own[k] += 0 if i in template or page.title[i] else page.texts[i].count(" ") + 1
        kind = next(k for k in range(kind, 1, -1) if 2 * own[k] >= own[2])
        body = [i for i in inside if page.holder[i][0] >= kind]
        heads = [i for i in inside if i < body[0] and page.title[i] and i not in template]
        if not any(page.title[i] for i in body):
            body = heads[-1:] + body
        return "\n\n".join(page.texts[i] for i in body)
    return "\n\n".join(page.texts[i] for i in inside if i not in template)


class HostWrapper:
    """A wrapper and up to TEMPLATE_PAGES hashes of different pages it was made from."""

    def __init__(self, nodes: list[dict], pages: list[int]):
        self.nodes, self.pages = nodes, pages

    def add(self, nodes: list[dict], pages: list[int]) -> None:
        new = [p for p in pages if p not in self.pages]
        if new:  # a page seen before teaches nothing
            self.nodes = merge(self.nodes, nodes)
            self.pages = sorted({*self.pages, *new})[:TEMPLATE_PAGES]

    def row(self) -> tuple[str, list[int]]:
        return json.dumps(self.nodes, separators=(",", ":")), self.pages


SCHEMA = "host string, wrapper string, pages array<long>"


def _rows(found: dict[str, HostWrapper]) -> pa.RecordBatch:
    rows = [(h, *w.row()) for h, w in found.items()]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
                                       pa.array([r[2] for r in rows], pa.list_(pa.int64()))], names=["host", "wrapper", "pages"])


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, HostWrapper] = {}
    for batch in batches:
        for url, markup in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not markup:
                continue
            host, seen = host_of(url), [zlib.crc32(markup.encode("utf-8", "surrogatepass"))]
            nodes = bare(generalise(Page(markup).tree))
            if host in found:
                found[host].add(nodes, seen)
            else:
                found[host] = HostWrapper(nodes, seen)
        if len(found) >= HOSTS_PER_FLUSH:
            yield _rows(found)
            found = {}
    yield _rows(found)


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    host, wrapper = None, None
    for batch in batches:
        for h, nodes, pages in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if wrapper is not None and h == host:
                wrapper.add(json.loads(nodes), pages)
                continue
            if wrapper is not None:
                yield _rows({host: wrapper})
            host, wrapper = h, HostWrapper(json.loads(nodes), pages)
    if wrapper is not None:
        yield _rows({host: wrapper})


def infer(pages: DataFrame, url: str = "url", markup: str = "html") -> DataFrame:
    """``host, wrapper`` (JSON), ``pages`` (hashes of a few different pages): one row per host."""
    partial = pages.select(F.col(url).alias("url"), F.col(markup).alias("markup")).mapInArrow(_infer, SCHEMA)
    return partial.repartition("host").sortWithinPartitions("host").mapInArrow(_combine, SCHEMA)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: tuple[str | None, list[dict]] = (None, [])
    for batch in batches:
        texts = []
        for markup, wrapper, seen in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
            page = Page(markup or "")
            template: set[int] = set()
            if wrapper and len(seen) >= TEMPLATE_PAGES:
                if known[0] != wrapper:
                    known = (wrapper, json.loads(wrapper))
                template = template_texts(known[1], generalise(page.tree))
            texts.append(main_text(page, template))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                         names=["key", "url", "text", "n_chars"])


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """One row per page: ``key, url, text, n_chars``."""
    from corpusprep.session import shared_path

    kind = pages.schema[key].dataType.simpleString()
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url), r"(?i)" + HOST.pattern, 1)), F.lit(""))
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(markup).alias("markup"), host.alias("host"))
    folder = shared_path(pages.sparkSession, "wrappers")
    infer(pages, url, markup).write.parquet(folder)
    wrappers = pages.sparkSession.read.parquet(folder)
    joined = rows.join(wrappers, "host", "left").select("key", "url", "markup", "wrapper", "pages")
    return joined.mapInArrow(_extract, f"key {kind}, url string, text string, n_chars long").toDF(key, url, "text", "n_chars")
