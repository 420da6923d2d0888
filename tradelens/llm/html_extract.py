"""Main text of web pages by wrapper induction.

Pages of one host share one or several templates. A host's pages are grouped by the
block elements they hold: of the neighbouring tags and the classes, those that
neither (nearly) all pages nor fewer than ``least`` have tell layouts apart; shapes
that share half of these are one group. A page of a shape too rare for a group is
read with the most alike group's wrapper, but not counted for it; a host without
any group of ``least`` pages is one group. In what follows "host" is such a group.

For every host one page (the smallest
``page_id``) serves as reference; each page's DOM tree is aligned with the
reference's by simple tree matching (equal tags, the best order-preserving
matching of children, recursively), and for every node of the reference the
pages are counted whose matched node holds the same text. Nodes that (nearly) all pages of the host share with equal text are the
wrapper's constants, that is template; nodes whose text varies are slots. Counts
are taken over all pages of a host; tasks add them up per batch before the
shuffle, so a host with a third of all pages is no hot key. Pages are not moved:
the wrappers are broadcast if their measured size allows, else joined on (host,
salt).

A page is then aligned again: matched constants go, as do nodes whose element or
class/id says menu, header, footer, sidebar, notice, advert, form, comment,
script or style. What remains of the article (``article``, else ``main``, else the
body; ``main`` also where it holds more text beside the articles than they do) is cut
into blocks. A class token or id says so if it has such a word and else only words for
a place or a container (``cookie-notice``, ``user-comments``, not ``with-sidebar`` or
``social-history``); headings are never judged by class or id, and nothing is judged
by being hidden. An article or main outside such elements is
preferred; where there is none, it is looked for inside them too, and no element
around it is cut.

Text: character references decoded, white space (Unicode's) in a block, ``br``
included, as one space, blocks in page order joined by an empty line; nothing else is dropped.

Defined cases: null or empty html gives an empty text; a page without url or
host is its own host; when constants leave nothing, the page's text without that
rule is taken; when a page without article and main holds text only in elements named
so by class or id, that text is taken; unclosed and misnested tags are closed as browsers do; rows with
equal page ids are separate; extra columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache
from html import unescape
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

# Fixed sets of HTML element names
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body html caption td th tr tbody thead tfoot legend".split())
# an opening tag of the key ends an open element of the set, up to the scope
IMPLIED_END = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
               "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
               "tbody": {"tbody", "thead", "tr", "td", "th"},
               "tfoot": {"tbody", "thead", "tr", "td", "th"}}
SCOPE = frozenset("ul ol dl table select body html article section div nav main aside footer "
                  "header".split())
# elements and class/id words that are never article text
DROP = frozenset("head script style noscript template iframe object embed svg math canvas audio "
                 "video nav header footer aside form button select option input textarea label "
                 "dialog menu title".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert "
                       "menu menubar toolbar".split())
DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav "
    "navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside cookie "
    "cookies consent gdpr notice popup modal overlay newsletter subscribe signup login comment "
    "comments disqus respond replies related recommended share sharing social widget toolbar "
    "pagination pager skip copyright".split())
# words for a place or a container, which leave a telling word beside them its meaning
AROUND_WORDS = frozenset(
    "area bar block bottom box btn button buttons container dialog feed form group holder icons "
    "inner item items left link links list message outer panel posts reader readers right section "
    "site slot stories strip thread top unit user users wrap wrapper zone".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[^\W\d_]+")
UNNAMED = frozenset("article main body html h1 h2 h3 h4 h5 h6 hgroup".split())


class Node:
    __slots__ = ("tag", "attrs", "kids", "parent", "key", "form", "number")

    def __init__(self, tag, attrs="", parent=None):
        self.tag, self.attrs, self.parent, self.kids = tag, attrs, parent, []
        self.key, self.form, self.number = None, None, -1


def parse(html: str) -> Node:
    """A tolerant DOM: elements as nodes, text as strings between them."""
    root = Node("#root")
    at, pos, n = root, 0, len(html)
    while pos < n:
        m = _TOKEN.search(html, pos)
        if m is None:
            at.kids.append(html[pos:])
            break
        if m.start() > pos:
            at.kids.append(html[pos:m.start()])
        pos = m.end()
        if not (tag := m[2]):
            if m[0].startswith("<![CDATA["):
                at.kids.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if m[1]:
            up = at
            while up is not root and up.tag != tag:
                if up.tag in ("article", "body", "table", "td", "th", "section", "main") and \
                        tag not in BLOCK:
                    up = root      # an inline end tag does not leave its block
                    break
                up = up.parent
            if up is not root:
                at = up.parent
            continue
        if tag in CLOSES_P:
            at = _close(at, {"p"})
        if tag in IMPLIED_END:
            at = _close(at, IMPLIED_END[tag])
        node = Node(tag, m[3], at)
        at.kids.append(node)
        if tag in VOID or m[3].endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, pos)
            node.kids.append(html[pos:end.start() if end else n])
            pos = end.end() if end else n
            continue
        at = node
    return root


def _close(at: Node, tags: set) -> Node:
    """The parent of the nearest open element of ``tags`` within the scope, else ``at``."""
    up = at
    while up.parent is not None and up.tag not in SCOPE:
        if up.tag in tags:
            return up.parent
        up = up.parent
    return at


def content(node: Node) -> int:
    """A hash of all text and tags under a node; 0 if there is no text."""
    todo = [node]
    while todo:
        x = todo[-1]
        if waiting := [k for k in x.kids if not isinstance(k, str) and k.key is None]:
            todo.extend(waiting)
            continue
        todo.pop()
        if x.key is None:
            parts = [" ".join(k.split()) if isinstance(k, str) else k.key for k in x.kids]
            x.key = hash((x.tag, *filter(None, parts))) or 1 if any(parts) else 0
    return node.key


def form(node: Node) -> tuple[int, int]:
    """(hash of the tree of tags under a node, its number of nodes)."""
    todo = [node]
    while todo:
        x = todo[-1]
        kids = elements(x)
        if waiting := [k for k in kids if k.form is None]:
            todo.extend(waiting)
            continue
        todo.pop()
        if x.form is None:
            x.form = hash((x.tag, *(k.form[0] for k in kids))), 1 + sum(k.form[1] for k in kids)
    return node.form


def elements(node: Node) -> list[Node]:
    return [k for k in node.kids if not isinstance(k, str)]


def number(root: Node) -> list[Node]:
    """All nodes in page order; their position is their number."""
    out, todo = [], [root]
    while todo:
        x = todo.pop()
        x.number = len(out)
        out.append(x)
        todo.extend(reversed(elements(x)))
    return out


KNOWN_PAIRS = 1 << 17     # sizes of matchings that a task keeps, about 200 bytes each


def _same(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """The pairs of two trees of one form."""
    out, todo = [], [(a, b)]
    while todo:
        x, y = pair = todo.pop()
        out.append(pair)
        todo.extend(zip(elements(x), elements(y)))
    return out


def _trim(a: Node, b: Node):
    """Children paired by equal forms at both ends, and the two lists left between."""
    ka, kb = elements(a), elements(b)
    least, lo, hi = min(len(ka), len(kb)), 0, 0
    while lo < least and ka[lo].form == kb[lo].form:
        lo += 1
    while hi < least - lo and ka[-1 - hi].form == kb[-1 - hi].form:
        hi += 1
    return ([*zip(ka[:lo], kb[:lo]), *zip(ka[len(ka) - hi:], kb[len(kb) - hi:])],
            ka[lo:len(ka) - hi], kb[lo:len(kb) - hi])


def _weights(ka: list[Node], kb: list[Node], known: dict):
    """Sizes of the matchings of all children, a row and a column per distinct form
    (a coroutine: it asks for the pairs it needs), and the lists' places in it."""
    fa, fb = {x.form: x for x in ka}, {y.form: y for y in kb}
    w = np.zeros((len(fa), len(fb)), np.int32)
    for i, x in enumerate(fa.values()):
        for j, y in enumerate(fb.values()):
            if x.tag != y.tag:
                continue
            if x.form == y.form:
                w[i, j] = x.form[1]
            elif x.form[1] == 1 or y.form[1] == 1:
                w[i, j] = 1
            else:
                n = known.get((x.form, y.form))
                w[i, j] = (yield x, y) if n is None else n
    ia, ib = {f: i for i, f in enumerate(fa)}, {f: j for j, f in enumerate(fb)}
    return (w, np.array([ia[x.form] for x in ka], np.intp),
            np.array([ib[y.form] for y in kb], np.intp))


def _rows(w, ia, ib, first, start: int, stop: int):
    """Rows ``start`` + 1 to ``stop`` of the dynamic program over two child lists."""
    up = first
    for i in range(start, stop):
        row = up.copy()
        np.maximum(row[1:], up[:-1] + w[ia[i], ib], out=row[1:])
        up = np.maximum.accumulate(row)
        yield up


def _size(a: Node, b: Node, known: dict):
    """The size of the best matching of two trees of one tag (a coroutine)."""
    fixed, ka, kb = _trim(a, b)
    size = 1 + sum(x.form[1] for x, _ in fixed)
    if ka and kb:
        w, ia, ib = yield from _weights(ka, kb, known)
        for last in _rows(w, ia, ib, np.zeros(len(kb) + 1, np.int32), 0, len(ka)):
            pass
        size += int(last[-1])
    if len(known) >= KNOWN_PAIRS:
        known.clear()
    known[a.form, b.form] = size
    return size


def _solve(task, known: dict):
    """Runs a coroutine; the pairs it asks for are solved on a stack of their own, so
    that depth does not matter."""
    stack, value = [task], None
    while stack:
        try:
            stack.append(_size(*stack[-1].send(value), known))
            value = None
        except StopIteration as done:
            stack.pop()
            value = done.value
    return value


def _aligned(ka: list[Node], kb: list[Node], known: dict) -> list[tuple[Node, Node]]:
    """The pairs of the best order-preserving matching of two child lists. Every
    n-th row of the program is kept and those between are made again on the way
    back, so that memory grows with the root of the lists' product."""
    w, ia, ib = _solve(_weights(ka, kb, known), known)
    step = math.isqrt(len(ka)) + 1
    row = np.zeros(len(kb) + 1, np.int32)
    kept = [row]
    for i, row in enumerate(_rows(w, ia, ib, row, 0, len(ka)), 1):
        if i % step == 0:
            kept.append(row)
    out, i, j, at, m = [], len(ka), len(kb), -1, []
    while i and j:
        if (i - 1) // step != at:
            at = (i - 1) // step
            m = [kept[at], *_rows(w, ia, ib, kept[at], at * step, min((at + 1) * step, len(ka)))]
        row, up = m[i - at * step], m[i - at * step - 1]
        if row[j] == up[j]:
            i -= 1
        elif row[j] == row[j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out.append((ka[i], kb[j]))
    return out


def match(a: Node, b: Node, known: dict | None = None) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching: the size of the best matching and its pairs.

    Trees of one form match whole, so child lists are first trimmed of equal
    forms at both ends. What is left goes through the dynamic program, whatever
    its length and depth; ``known`` keeps sizes by the forms of the two trees."""
    if a.tag != b.tag:
        return 0, []
    known = {} if known is None else known
    form(a), form(b)
    pairs, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        if x.form == y.form:
            pairs += _same(x, y)
            continue
        pairs.append((x, y))
        fixed, ka, kb = _trim(x, y)
        for p, q in fixed:
            pairs += _same(p, q)
        if ka and kb:
            todo += _aligned(ka, kb, known)
    return len(pairs), pairs


def _dropped(node: Node, names: bool = True) -> bool:
    """Never article text; ``names``: by its class or id as well."""
    if node.tag in DROP:
        return True
    if not node.attrs:
        return False
    for m in _ATTR.finditer(node.attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if names and name in ("class", "id") and node.tag not in UNNAMED:
            for token in value.split():
                if _telling(token):
                    return True
        if name == "role" and value in DROP_ROLES:
            return True
    return False


@lru_cache(1 << 16)
def _telling(token: str) -> bool:
    """A class token or id that says its element is never article text."""
    found = set(_WORDS.findall(token))
    return not found.isdisjoint(DROP_WORDS) and found <= DROP_WORDS | AROUND_WORDS


def _find(root: Node, tag: str, names: bool = True) -> list[Node]:
    """Outermost elements of the tag that no dropped element holds."""
    out, todo = [], [root]
    while todo:
        x = todo.pop()
        if x.tag == tag:
            out.append(x)
        elif not _dropped(x, names):
            todo.extend(reversed(elements(x)))
    return out


def _chars(nodes: list[Node], skip: set[Node], most: float = math.inf) -> int:
    """Characters of text under the nodes, but for dropped ones and ``skip``; stops at ``most``."""
    n, todo = 0, [x for node in nodes for x in node.kids]
    while todo and n <= most:
        x = todo.pop()
        if isinstance(x, str):
            n += len("".join(x.split()))
        elif x not in skip and not _dropped(x):
            todo += x.kids
    return n


def _article(root: Node) -> list[Node]:
    """The elements that hold the main text."""
    articles, mains = _find(root, "article"), _find(root, "main")
    if articles and mains:
        # cards in a main, or teasers beside it, are not the article
        beside = _chars(mains, set(articles))
        if beside and _chars(articles, set(), beside) < beside:
            return mains
    return articles or mains or _find(root, "article", False) or _find(root, "main", False) or [root]


def blocks(root: Node, constants: set[int], names: bool = True) -> list[str]:
    """Texts of the blocks under the article, without dropped nodes and template."""
    top = _article(root)
    names = names or top != [root]
    around = set()                    # a main may wrap its article in such an element
    if not _find(root, "article"):
        for x in _find(root, "article", False):
            while (x := x.parent) is not None:
                around.add(x)
    out, line = [], []

    def flush():
        text = " ".join(unescape("".join(line)).split())
        line.clear()
        if text:
            out.append(text)

    for node in top:
        todo: list = [node]
        while todo:
            x = todo.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                line.append(x)
            elif x.tag == "br":
                line.append(" ")
            elif x is node or not (_dropped(x, names and x not in around)
                                   or x.number in constants):
                if x.tag in BLOCK:
                    flush()
                    todo.append(None)
                todo.extend(reversed(x.kids))
        flush()
    return out


def extract(html: str | None, reference: str | None = None, template: frozenset = frozenset(),
            parsed: dict | None = None, known: dict | None = None) -> str:
    """The main text of one page, given its host's reference page and constants."""
    if not html:
        return ""
    root = parse(html)
    number(root)
    constants = set()
    if template and reference:
        ref = _reference(reference, parsed)
        constants = {y.number for x, y in match(ref[0], root, known)[1]
                     if x.number in template and content(x) == content(y)}
    got = blocks(root, constants) or blocks(root, set()) or \
        blocks(root, constants, False) or blocks(root, set(), False)
    return "\n\n".join(got)


def _reference(html: str, parsed: dict | None) -> tuple[Node, frozenset]:
    """The parsed reference page with the numbers of the nodes that hold text and
    are not dropped anyway; a task keeps those it has met."""
    if parsed is not None and html in parsed:
        return parsed[html]
    root = parse(html)
    number(root)
    open_, todo = set(), [root]
    while todo:
        x = todo.pop()
        if not _dropped(x) and content(x):
            open_.add(x.number)
            todo.extend(elements(x))
    got = root, frozenset(open_)
    if parsed is not None:
        if len(parsed) >= 256:
            parsed.clear()
        parsed[html] = got
    return got


ALIKE = 0.5
_OPEN = re.compile(r"<([a-zA-Z][a-zA-Z0-9]*)([^>]*)")


def shape(html: str) -> bytes:
    """A page's block elements: hashes of neighbouring tags and of classes."""
    found, last = set(), ""
    for tag, attrs in _OPEN.findall(html):
        if (tag := tag.lower()) not in BLOCK:
            continue
        found.add(f"{last}>{tag}")
        last = tag
        for m in _ATTR.finditer(attrs):
            if m[1].lower() == "class":
                found.update(f"{tag}.{c}" for c in (m[2] or m[3] or m[4] or "").split()
                             if not any(map(str.isdigit, c)))
    return np.array(sorted({crc32(x.encode()) for x in found}), np.uint32).tobytes()


def _features(b: bytes) -> frozenset[int]:
    return frozenset(np.frombuffer(b, np.uint32).tolist())


def _bytes(features) -> bytes:
    return np.array(sorted(features), np.uint32).tobytes()


def _alike(a: frozenset, b: frozenset) -> float:
    return len(a & b) / len(a | b) if a or b else 1.0


SHAPES = pa.schema([("host", pa.string()), ("shape", pa.binary()), ("pages", pa.int64())])


def _shape_batches(batches):
    for b in batches:
        n = Counter(zip(b.column("host").to_pylist(), map(shape, b.column("html").to_pylist())))
        cols = [*zip(*n)] or [(), ()]
        yield pa.record_batch([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.binary()),
                               pa.array(list(n.values()), pa.int64())], schema=SHAPES)


HELD = pa.schema([("host", pa.string()), ("feature", pa.int64()), ("pages", pa.int64())])


def _feature_batches(batches):
    """Pages by host and feature; the feature -1 counts all pages of the host."""
    for b in batches:
        n: Counter = Counter()
        for host, f, pages in zip(*(b.column(c).to_pylist() for c in ("host", "shape", "pages"))):
            for x in (-1, *_features(f)):
                n[host, x] += pages
        cols = [*zip(*n)] or [(), ()]
        yield pa.record_batch([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
                               pa.array(list(n.values()), pa.int64())], schema=HELD)


def _telling_batches(batches):
    """Shapes cut to the features that tell their host's layouts apart."""
    for b in batches:
        known: dict = {}
        n: Counter = Counter()
        for host, f, pages, telling in zip(*(b.column(c).to_pylist() for c in (
                "host", "shape", "pages", "telling"))):
            if host not in known:
                known[host] = frozenset(telling or ())
            n[host, _bytes(_features(f) & known[host])] += pages
        cols = [*zip(*n)] or [(), ()]
        yield pa.record_batch([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.binary()),
                               pa.array(list(n.values()), pa.int64())], schema=SHAPES)


LAYOUTS = pa.schema([("host", pa.string()), ("layouts", pa.list_(pa.binary()))])


def _layouts(least: int):
    """Per host: one set of telling features a layout."""
    def run(key, t):
        sets = [(_features(f), n) for f, n in zip(t.column("shape").to_pylist(),
                                                  t.column("pages").to_pylist())]
        found: dict = {}
        for f, n in sorted(sets, key=lambda x: (-x[1], sorted(x[0]))):
            best = max(found, key=lambda g: _alike(f, g), default=None)
            if best is None or _alike(f, best) < ALIKE:
                best = f
            found[best] = found.get(best, 0) + n
        return pa.Table.from_arrays([
            pa.array([key[0].as_py()], pa.string()),
            pa.array([[_bytes(f) for f, n in found.items() if n >= least]],
                     pa.list_(pa.binary()))], schema=LAYOUTS)
    return run


PLACED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string()),
                    ("host", pa.string()), ("member", pa.bool_())])


def _place_batches(batches):
    """Pages with the number of their layout before the host."""
    for b in batches:
        hosts, member, known = [], [], {}
        for host, html, telling, layouts in zip(*(b.column(c).to_pylist() for c in (
                "host", "html", "telling", "layouts"))):
            at, best = 0, 1.0
            if html and layouts:
                if host not in known:
                    known[host] = frozenset(telling or ()), [_features(x) for x in layouts], {}
                told, sets, dealt = known[host]
                f = _features(shape(html)) & told
                if f not in dealt:
                    near = [_alike(f, x) for x in sets]
                    dealt[f] = near.index(max(near)), max(near)
                at, best = dealt[f]
            hosts.append(None if host is None else f"{at} {host}")
            member.append(best >= ALIKE)
        yield pa.record_batch([b.column("page_id"), b.column("url"), b.column("html"),
                               pa.array(hosts, pa.string()), pa.array(member, pa.bool_())],
                              schema=PLACED)


def _by_layout(p: DataFrame, share: float, least: int, limit: int) -> DataFrame:
    """The pages with their host and layout as ``host``. Features are counted over all shapes
    of a host; what its one group holds is its distinct sets of telling features."""
    shapes = cut_lineage(p.where("host is not null and html <> ''").select("host", "html").mapInArrow(
        _shape_batches, "host string, shape binary, pages long").groupBy("host", "shape").agg(
        F.sum("pages").alias("pages")))
    held = shapes.mapInArrow(_feature_batches, "host string, feature long, pages long").groupBy(
        "host", "feature").agg(F.sum("pages").alias("pages"))
    total = held.where("feature = -1").select("host", F.col("pages").alias("total"))
    telling = held.where((F.col("feature") >= 0) & (F.col("pages") >= least)).join(
        total, "host").where(F.col("pages") < F.lit(share) * F.col("total")).groupBy("host").agg(
        F.array_sort(F.collect_list("feature")).alias("telling"))
    sets = shapes.join(telling, "host", "left").mapInArrow(
        _telling_batches, "host string, shape binary, pages long").groupBy("host", "shape").agg(
        F.sum("pages").alias("pages"))
    layouts = cut_lineage(sets.groupBy("host").applyInArrow(
        _layouts(least), "host string, layouts array<binary>").join(telling, "host", "left"))
    size = 8 * F.coalesce(F.size("telling"), F.lit(0)) * (F.size("layouts") + 1) + 256
    return _with_wrapper(p, layouts, "left", limit, size).select(
        "page_id", "url", "html", "host", "telling", "layouts").mapInArrow(
        _place_batches, "page_id long, url string, html string, host string, member boolean")


COUNTS = pa.schema([("host", pa.string()), ("pages", pa.int64()), ("counts", pa.binary())])


def _count_batches(batches):
    """Per batch and host, for every node of the reference: pages with its text there."""
    parsed, known = {}, {}
    for b in batches:
        found: dict[str, list] = {}
        for host, html, ref in zip(*(b.column(c).to_pylist() for c in ("host", "html", "reference"))):
            if not html or not ref:
                continue
            root, open_ = _reference(ref, parsed)
            have = found.setdefault(host, [0, np.zeros(max(open_, default=0) + 1, np.int64)])
            have[0] += 1
            for x, y in match(root, parse(html), known)[1]:
                if x.number in open_ and content(x) == content(y):
                    have[1][x.number] += 1
        yield pa.record_batch([pa.array(list(found), pa.string()),
                               pa.array([v[0] for v in found.values()], pa.int64()),
                               pa.array([v[1].tobytes() for v in found.values()], pa.binary())],
                              schema=COUNTS)


TEMPLATES = pa.schema([("host", pa.string()), ("template", pa.list_(pa.int32()))])


def _templates(share: float, least: int):
    def run(key, t):
        pages, total = 0, 0
        for n, c in zip(t.column("pages").to_pylist(), t.column("counts").to_pylist()):
            pages, total = pages + n, total + np.frombuffer(c, np.int64)
        nodes = np.flatnonzero(total >= share * pages) if pages >= least else []
        return pa.Table.from_arrays([pa.array([key[0].as_py()], pa.string()),
                                     pa.array([list(map(int, nodes))], pa.list_(pa.int32()))],
                                    schema=TEMPLATES)
    return run


TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()),
                   ("n_chars", pa.int64())])


def _extract_batches(batches):
    parsed, known = {}, {}
    for b in batches:
        text = [extract(h, r, frozenset(t or ()), parsed, known) for h, r, t in zip(
            *(b.column(c).to_pylist() for c in ("html", "reference", "template")))]
        yield pa.record_batch([b.column("page_id"), b.column("url"), pa.array(text, pa.string()),
                               pa.array([len(t) for t in text], pa.int64())], schema=TEXTS)


def main_text(pages: DataFrame, share: float = 0.9, least: int = 5,
              broadcast_bytes: int = 16 << 20) -> DataFrame:
    """page_id, url, text, n_chars per page. A node is template if at least ``share``
    of a host's pages of one layout (``least`` or more) repeat the reference's text there."""
    host = F.lower(F.regexp_extract(F.col("url"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    p = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                     F.col("html").cast("string")).withColumn(
        "host", F.when(host != "", host))
    p = _by_layout(p, share, least, broadcast_bytes)
    counted = p.where("host is not null and html <> '' and member").drop("member")
    refs = cut_lineage(counted.groupBy("host").agg(
        F.min_by("html", F.struct("page_id", F.md5("html"))).alias("reference")))
    aligned = _with_wrapper(counted, refs, "inner", broadcast_bytes)
    counts = aligned.mapInArrow(_count_batches, "host string, pages long, counts binary")
    found = counts.groupBy("host").applyInArrow(
        _templates(share, least), "host string, template array<int>")
    wrappers = cut_lineage(refs.join(found, "host"))
    return _with_wrapper(p, wrappers, "left", broadcast_bytes).select(
        "page_id", "url", "html", "reference", "template").mapInArrow(
        _extract_batches, "page_id long, url string, text string, n_chars long")


def _with_wrapper(p: DataFrame, wrappers: DataFrame, how: str, limit: int,
                  size=None) -> DataFrame:
    """Pages with their host's wrapper: by broadcast if all wrappers are measured to
    be small, else by a join on (host, salt) that splits large hosts."""
    size = F.length("reference") + 256 if size is None else size
    if (wrappers.agg(F.sum(size)).first()[0] or 0) <= limit:
        return p.join(F.broadcast(wrappers), "host", how)
    n = p.groupBy("host").count().select("host", F.ceil(F.col("count") / 4096).alias("salts"))
    salted = wrappers.join(n, "host").withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).drop("salts")
    return p.join(n, "host", "left").withColumn("salt", F.coalesce(F.pmod(
        F.xxhash64("page_id", "url"), F.col("salts")), F.lit(0).cast("long"))).drop("salts").join(
        salted, ["host", "salt"], how)
