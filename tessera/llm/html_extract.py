"""Main text of web pages: content region, chrome rules, and removal of
subtrees that recur across a host's pages.

A page is parsed into a tree (unclosed tags, void elements and truncated pages
are tolerated). Its *content* is its ``article`` elements, else ``main``, else
the body. From the content go elements that are chrome by their tag, role or
class (menus, footers, forms, adverts, notices, comments, ...) and *templates*:
element subtrees, hashed over tag, classes and normalised text, that occur on
many pages of the same host. Counting is one Spark aggregate per (host, hash);
copies of a page (equal body text) count once, so a copied article does not
look like a template.

A passage of an article may recur on purpose (a licence, a quotation). Inside
``article`` and ``main`` therefore only containers (``div``, ``section``, ...) can be
templates; paragraphs and headings always stay. In pages without such a
region any block can be one.

Many pages are ``MIN_SHARE`` of a host's different pages, or ``MANY_PAGES`` of them
however large the host is, and never under ``MIN_PAGES``. The templates of a host
with up to ``LIST_HASHES`` are joined to its pages as one list by host. Those of a
larger list are joined to the (host, hash) rows of its pages, so a page gets only
the templates it has. Both come from written tables, broadcast only if their
files are small; the html is parsed twice and never written.

Defined results: a null or empty html, or one without text, gives an empty
text; a null or odd url is a host of its own (''); repeated rows are treated
alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
import sys
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import map_batches
from tessera.session import materialize

MIN_PAGES = 5
MIN_SHARE = 0.1
MANY_PAGES = 50           # many on a host of any size
LIST_HASHES = 1000        # templates that a host's pages get as one list

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp noembed noframes".split())
_INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt "
                    "ruby s samp small span strike strong sub sup time tt u var td th".split())
_SPACED = frozenset(("br", "td", "th", "img", "wbr"))
_DROPPED = frozenset("head script style noscript template nav footer aside form button input select "
                     "textarea option iframe object embed svg canvas audio video map dialog menu "
                     "title link meta".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert "
                   "menu menubar toolbar".split())
_NAMES = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner nav "
                   "navbar navigation menu breadcrumb breadcrumbs footer sidebar cookie cookies consent "
                   "gdpr notice popup modal overlay newsletter subscribe subscription share sharing social "
                   "related recommended comment comments disqus replies respond toolbar pagination pager "
                   "masthead".split())
# a class or id is a name of chrome by its last word, or by its first one before a word
# for a part of the page; a word for a state makes it none ("has-sidebar")
_PARTS = frozenset("box bar block widget list links buttons icons wrap wrapper container area section panel "
                   "inner left right top bottom unit slot form header title item items content".split())
_STATES = frozenset("has no not with without is are show hide hidden open opened closed enabled disabled".split())
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_REGION = frozenset(("html", "body", "article", "main"))
_TEXT_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre tr td th caption figcaption ul ol dl "
                        "table tbody thead tfoot article main body html".split())
# an opening tag that ends an open element of the second set, up to a barrier
_P_ENDERS = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 "
                      "h6 header hr main menu nav ol p pre section table ul details".split())
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
             "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_BARRIER = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",),
            "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.DOTALL)
_ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|\Z)""",
                   re.IGNORECASE)
_SPLIT = re.compile(r"[^a-z0-9]+")


class Element:
    __slots__ = ("tag", "names", "named", "hidden", "parent", "nodes", "most")

    def __init__(self, tag: str, names: frozenset[str], named: bool, hidden: bool, parent: Element | None):
        self.tag, self.names, self.named, self.hidden, self.parent = tag, names, named, hidden, parent
        self.most = False           # holds more than half of the page's text
        self.nodes: list[Element | str] = []


_NO_NAMES: frozenset[str] = frozenset()


def chrome_name(token: str) -> bool:
    """Whether a class or id names chrome, as ``sidebar``, ``cookie-notice`` or
    ``nav-bar`` do, and ``has-sidebar``, ``nav-open`` or ``related-work`` do not."""
    words = [x for x in _SPLIT.split(token) if x]
    if not words or not _STATES.isdisjoint(words):
        return False
    return words[-1] in _NAMES or words[0] in _NAMES and words[-1] in _PARTS


def _attributes(source: str) -> tuple[frozenset[str], bool, bool]:
    """Words of class, id and role; whether one names chrome; whether the element is hidden."""
    if "=" not in source and "hidden" not in source:
        return _NO_NAMES, False, False
    names, named, hidden = [], False, False
    for m in _ATTR.finditer(source):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "role":
            names.append("role:" + value.strip())
        elif key in ("class", "id"):
            names += [x for x in _SPLIT.split(value) if x]
            named = named or any(map(chrome_name, value.split()))
        elif key == "hidden" or value == "true":
            hidden = True
    return frozenset(names), named, hidden


def parse(source: str) -> Element:
    root = Element("html", _NO_NAMES, False, False, None)
    here, at, n = root, 0, len(source)
    count: Counter[str] = Counter()         # open elements by tag

    def leave(e: Element) -> None:
        """``e`` and what is open in it end."""
        nonlocal here
        while here is not e:
            count[here.tag] -= 1
            here = here.parent
        count[e.tag] -= 1
        here = e.parent

    def close(tags: tuple[str, ...], barrier: tuple[str, ...]) -> None:
        if not any(count[t] for t in tags):
            return
        e = here
        while e.parent is not None and e.tag not in barrier:
            if e.tag in tags:
                leave(e)
                return
            e = e.parent

    while at < n:
        lt = source.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            here.nodes.append(source[at:lt])
        if lt == n:
            break
        m = _TAG.match(source, lt)
        if m is None:                      # a bare "<"
            here.nodes.append("<")
            at = lt + 1
            continue
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:                    # a comment, doctype or the like
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            if tag == "p":
                close(("p",), ())
            elif tag not in _VOID and count[tag]:
                e = here
                while e.tag != tag:
                    e = e.parent
                leave(e)
            continue
        if tag == "html":
            continue
        if tag in _P_ENDERS:
            close(("p",), ("td", "th", "button", "table"))
        if tag in _SIBLINGS:
            close(_SIBLINGS[tag], _BARRIER[tag])
        element = Element(tag, *_attributes(m[3] or m[6] or ""), here)
        here.nodes.append(element)
        if tag in _RAW:
            end = re.compile(rf"</{tag}[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
            element.nodes.append(source[at:end.start() if end else n])
            at = end.end() if end else n
        elif tag not in _VOID:
            here = element
            count[tag] += 1
    _weigh(root)
    return root


def _in_page_order(root: Element) -> list[Element]:
    out, todo = [], [root]
    while todo:
        e = todo.pop()
        out.append(e)
        todo += [x for x in reversed(e.nodes) if not isinstance(x, str)]
    return out


def _weigh(root: Element) -> None:
    """Mark the elements with more than half of the text that is not in dropped
    or hidden ones; let functions that go down the tree go as deep as it is."""
    order = _in_page_order(root)
    mass: dict[int, int] = {}
    for e in reversed(order):
        mass[id(e)] = sum(len(x.strip()) if isinstance(x, str) else mass[id(x)] for x in e.nodes) if (
            e.tag not in _DROPPED and not e.hidden) else 0
    for e in order:
        e.most = 2 * mass[id(e)] > mass[id(root)]
    # a page has at most as many levels as elements
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 2 * len(order) + 1000))


def is_chrome(e: Element) -> bool:
    """By tag, role and name; names are hints, so never a heading's or that of an
    element that holds most of the page's text."""
    if e.tag in ("html", "body", "main"):
        return False
    if e.tag in _DROPPED or e.hidden:
        return True
    if e.tag == "header":                  # an article's own header holds its heading
        return not _has(e, _HEADINGS) or not _inside(e, ("article", "main"))
    if e.names and any(x[5:] in _ROLES for x in e.names if x.startswith("role:")):
        return True
    return e.named and not e.most and e.tag not in _HEADINGS


def _has(e: Element, tags: tuple[str, ...]) -> bool:
    return any(x.tag in tags for x in _in_page_order(e)[1:])


def _inside(e: Element, tags: tuple[str, ...]) -> bool:
    p = e.parent
    while p is not None:
        if p.tag in tags:
            return True
        p = p.parent
    return False


def content(root: Element) -> tuple[list[Element], bool]:
    """The content elements in page order, and whether they are a marked region.

    Chosen by their text outside links and chrome: the articles, if they have half
    of what ``main`` has and an eighth of the page's; else ``main``, if it has an
    eighth; else the page."""
    order = _in_page_order(root)
    mass: dict[int, int] = {}
    chrome = {id(e) for e in order[1:] if is_chrome(e)}
    for e in reversed(order):
        mass[id(e)] = 0 if id(e) in chrome or e.tag == "a" else sum(
            len(x.strip()) if isinstance(x, str) else mass[id(x)] for x in e.nodes)
    marked: dict[str, list[Element]] = {"article": [], "main": []}
    for tag, found in marked.items():
        todo = [root]
        while todo:
            e = todo.pop()
            if id(e) in chrome:
                continue
            if e.tag == tag or tag == "main" and "role:main" in e.names:
                found.append(e)
            else:
                todo += [x for x in reversed(e.nodes) if not isinstance(x, str)]
    articles, mains = (sum(mass[id(e)] for e in found) for found in marked.values())
    if marked["article"] and 2 * articles >= mains and 8 * articles >= mass[id(root)]:
        return marked["article"], True
    if marked["main"] and 8 * mains >= mass[id(root)]:
        return marked["main"], True
    return [root], False


def _text(pieces: list[str]) -> str:
    joined = "".join(pieces)
    return " ".join((html.unescape(joined) if "&" in joined else joined).split())


def _digest(key: str) -> int:
    h = xxhash.xxh64_intdigest(key.encode("utf-8", "replace"))
    return h - (1 << 64) if h >> 63 else h


def subtree_hashes(root: Element) -> dict[int, int]:
    """Hash of every block element of the page, by ``id(element)``: tag, class
    words, and its children (texts normalised), so equal subtrees are equal."""
    out: dict[int, int] = {}

    def visit(e: Element) -> str:
        parts: list[str] = []
        run: list[str] = []
        for x in e.nodes:
            if isinstance(x, str):
                run.append(x)
            elif x.tag in _INLINE or x.tag in _VOID:
                run += [" ", visit(x), " "]
            elif x.tag not in ("script", "style", "head"):
                if run:
                    parts.append(_text(run))
                    run = []
                parts.append(visit(x))
        if run:
            parts.append(_text(run))
        inner = "\x1f".join(p for p in parts if p)
        if e.tag in _INLINE or e.tag in _VOID:
            return inner
        h = _digest(f"{e.tag}\x1e{' '.join(sorted(e.names))}\x1e{inner}")
        out[id(e)] = h
        return str(h)

    visit(root)
    return out


def page_subtrees(source: str | None) -> tuple[int, list[int]]:
    """Hash of the whole page, and of the subtrees that may be templates."""
    if not source:
        return 0, []
    root = parse(source)
    hashes = subtree_hashes(root)
    regions, marked = content(root)
    kept = {id(r) for r in regions} if marked else set()
    found: set[int] = set()
    todo = [(root, False)]
    while todo:
        e, inside = todo.pop()
        inside = inside or id(e) in kept
        # in a marked region only containers count; the page itself never does
        if id(e) in hashes and e.tag not in _REGION and not (inside and e.tag in _TEXT_BLOCK):
            found.add(hashes[id(e)])
        todo += [(x, inside) for x in e.nodes if not isinstance(x, str) and x.tag not in ("script", "style", "head")]
    return hashes[id(root)], sorted(found)


def extract(source: str | None, templates: frozenset[int] = frozenset()) -> str:
    """Main text of a page, given its host's template hashes."""
    if not source:
        return ""
    root = parse(source)
    regions, marked = content(root)
    hashes = subtree_hashes(root) if templates else {}
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        if run:
            text = _text(run)
            if text:
                blocks.append(text)
            run.clear()

    def visit(e: Element) -> None:
        for x in e.nodes:
            if isinstance(x, str):
                run.append(x)
            elif x.tag in _SPACED:
                run.append(" ")
                if x.nodes and not is_chrome(x):
                    visit(x)
                    run.append(" ")
            elif is_chrome(x):
                if x.tag not in _INLINE:
                    flush()
            elif x.tag in _INLINE:
                visit(x)
            else:
                flush()
                if not (hashes.get(id(x)) in templates and x.tag not in _REGION
                        and not (marked and x.tag in _TEXT_BLOCK)):
                    visit(x)
                flush()

    for region in regions:
        visit(region)
        flush()
    return "\n\n".join(blocks)


_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), _HOST, 1))
    return pages.select("page_id", "url", "html", host.alias("host"))


def host_subtrees(hosted: DataFrame) -> DataFrame:
    """``host, source, page, hashes`` of every page, written: the hashes of its
    html, of its whole tree and of the subtrees that may be templates."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [page_subtrees(x) for x in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([r[0] for r in rows], pa.int64()),
             pa.array([r[1] for r in rows], pa.list_(pa.int64()))], names=["host", "source", "page", "hashes"])

    return materialize(map_batches(hosted.select("host", F.xxhash64("html").alias("source"), "html"), run, T.StructType([
        T.StructField("host", T.StringType()), T.StructField("source", T.LongType()),
        T.StructField("page", T.LongType()), T.StructField("hashes", T.ArrayType(T.LongType()))])), "trees")


def host_templates(hosted: DataFrame, min_pages: int = MIN_PAGES,
                   min_share: float = MIN_SHARE, trees: DataFrame | None = None) -> DataFrame:
    """``host, hash, n_pages``: subtrees on at least ``min_pages`` different
    pages and ``min_share`` of the host's different pages, or ``MANY_PAGES`` of them."""
    pages = host_subtrees(hosted) if trees is None else trees
    # the page itself is counted along, as hash null
    rows = pages.select("host", "page", F.explode(F.concat(
        F.array(F.lit(None).cast("long")), "hashes")).alias("hash")).distinct()
    counts = materialize(rows.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n_pages"))
                         .where(F.col("hash").isNull() | (F.col("n_pages") >= min_pages)), "subtrees")
    total = counts.where(F.col("hash").isNull()).select("host", F.col("n_pages").alias("total"))
    return (counts.where(F.col("hash").isNotNull()).join(total, "host")
            .where(F.col("n_pages") >= F.least(F.col("total") * min_share, F.lit(float(MANY_PAGES))))
            .select("host", "hash", "n_pages"))


def extract_text(pages: DataFrame, min_pages: int = MIN_PAGES,
                 min_share: float = MIN_SHARE) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    hosted = with_host(pages)
    trees = host_subtrees(hosted)
    found = materialize(host_templates(hosted, min_pages, min_share, trees), "found")
    sizes = found.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.where(F.col("n") > LIST_HASHES).select("host")
    templates = materialize(
        found.join(large, "host", "left_anti").groupBy(F.col("host").alias("of"))
        .agg(F.collect_list("hash").alias("templates")), "templates")
    own = materialize(
        trees.join(large, "host", "left_semi").select("host", "source", F.explode("hashes").alias("hash"))
        .join(found.select("host", "hash"), ["host", "hash"])
        .groupBy(F.col("host").alias("own_host"), F.col("source").alias("own_source"))
        .agg(F.collect_set("hash").alias("own")), "own")
    joined = hosted.join(templates, F.col("host") == F.col("of"), "left").join(
        own, (F.col("host") == F.col("own_host")) & (F.xxhash64("html") == F.col("own_source")), "left").select(
        "page_id", "url", "html", F.coalesce("templates", "own").alias("templates"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets: dict[tuple, frozenset[int]] = {}
        texts = []
        for source, known in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            key = tuple(known or ())
            if key not in sets:
                sets[key] = frozenset(key)
            texts.append(extract(source, sets[key]))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return map_batches(joined, run, T.StructType([
        pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType()),
        T.StructField("n_chars", T.LongType())]))
