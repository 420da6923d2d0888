"""Nearest neighbours, archives and page text."""

import gzip
import hashlib
import math
import random

import numpy as np
import pytest

from tradelens.llm import ann, warc
from tradelens.llm.html_extract import extract, main_text, match, number, parse

EMB = "vec_id long, embedding array<float>, label int, rank int, score double, v string, shard int"


def vectors(n, dim, rng):
    return [[float(x) for x in v] for v in rng.normal(size=(n, dim)).astype(np.float32)]


@pytest.fixture(scope="module")
def emb_rows():
    rng = np.random.default_rng(1)
    v = vectors(900, 16, rng)
    rows = [(i, x) for i, x in enumerate(v)]
    rows += [(1000 + i, v[5]) for i in range(400)]                    # one very common vector
    rows += [(1900, None), (2000, [0.0] * 16), (2001, [None] + v[0][1:]), (2002, v[1][:7]),
             (2003, [float("nan")] + v[0][1:]), (2004, [float("inf")] + v[0][1:]), (None, v[2]),
             (2100, []), (3, v[3]), (200, v[200])]
    return rows


@pytest.fixture(scope="module")
def emb(spark, emb_rows):
    return spark.createDataFrame([(i, x, 1, 2, 3.0, "v", 4) for i, x in emb_rows], EMB)


def brute_nearest(rows, top=10):
    ok = [(i, x) for i, x in rows if i is not None and x and len(x) == 16
          and all(c is not None and math.isfinite(c) for c in x) and any(x)]
    ids, m = np.array([i for i, _ in ok]), np.array([x for _, x in ok])
    out = {}
    for i, x in ok:
        if i % 100 == 0:
            d = np.sqrt(((m - np.array(x)) ** 2).sum(1))
            c = np.flatnonzero(ids != i)
            best = c[np.lexsort((ids[c], d[c]))[:top]]
            out[i] = [(int(ids[k]), float(d[k])) for k in best]
    return out


def test_nearest_recall_and_order(spark, emb, emb_rows):
    want = brute_nearest(emb_rows)
    got = {}
    for r in ann.nearest(emb, emb.where("vec_id % 100 = 0"), shard_rows=200).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(want)
    hits = 0
    for q, w in want.items():
        g = sorted(got[q])
        assert [x[0] for x in g] == list(range(1, 11))
        assert [(x[2], x[1]) for x in g] == sorted((x[2], x[1]) for x in g)
        hits += len({x[1] for x in g} & {i for i, _ in w})
    assert hits >= 0.9 * 10 * len(want)
    # every bucket visited: exactly the brute-force result
    full = ann.nearest(emb, emb.where("vec_id % 100 = 0"), tables=1, k=1, probes=2, w_std=1e6)
    rows = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in full.collect())
    assert [(q, i) for q, _, i, _ in rows] == [(q, i) for q in sorted(want) for i, _ in want[q]]
    assert np.allclose([s for *_, s in rows], [s for q in sorted(want) for _, s in want[q]])


def test_nearest_small_and_empty(spark, emb):
    few = emb.where("vec_id in (0, 1, 2)")
    assert ann.nearest(few, few.where("vec_id = 0")).count() <= 2
    none = emb.where("vec_id < 0")
    assert ann.nearest(none, none).count() == 0
    assert ann.nearest(emb, none).count() == 0


def test_nearest_lists_are_complete(spark, emb, emb_rows):
    few = emb.where("vec_id in (0, 1, 2)")
    assert ann.nearest(few, few.where("vec_id = 0")).count() == 2
    # outliers: all buckets around them are empty, thousands of steps away
    far = [(i, [1e4 * i + j for j in range(16)]) for i in (3000, 3100)]
    rows = [(i, x) for i, x in emb_rows if i is not None and i < 900] + far
    df = spark.createDataFrame([(i, x, 1, 2, 3.0, "v", 4) for i, x in rows], EMB)
    want, got = brute_nearest(rows), {}
    for r in ann.nearest(df, df.where("vec_id % 100 = 0"), shard_rows=200).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert {q: len(g) for q, g in got.items()} == {q: 10 for q in want}
    for q, _ in far:
        assert [i for _, i, _ in sorted(got[q])] == [i for i, _ in want[q]]


def test_probes_come_in_order_and_differ():
    sets = ann.perturbations(5, 40)
    assert sets[0] == () and sets[1] == (1,) and len(sets) == len(set(sets)) == 41
    assert not any(11 - j in s for s in sets for j in s)
    h = ann.Hashes(8, 2, 4, 30, 1.0, 0)
    q = np.random.default_rng(0).normal(size=(3, 8))
    p = h.probe_keys(0, q)
    assert (p[:, 0] == h.keys(0, q)).all() and all(len(set(r)) == len(r) for r in p.tolist())


PAGES = "page_id long, url string, html string, digest string, bytes int, first int, host string"
HTML = "<p>" + "Text with ünïcode and\r\n\r\nbreaks. " * 8 + "</p>"
ROWS = [(5, "http://a/x", HTML), (3, "http://a/y z\n", HTML), (9, None, HTML), (3, "http://a/y z\n", HTML),
        (1, "http://b", None), (2, "http://b", ""), (4, "http://c", "short"), (6, "http://c", "short"),
        (None, "http://d", HTML), (None, None, "y" * 200), (7, "u", "z" * 300000),
        (8, "u", "WARC/1.0\r\nx\r\n\r\n" * 20)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "d", 1, 2, "h") for r in ROWS], PAGES).repartition(3)


@pytest.mark.parametrize("version", [1, 2])
def test_pages_through_archives(spark, pages, version):
    got = warc.pages_to_warc(pages, version).collect()
    want = []
    for i, _, html in ROWS:
        b = (html or "").encode()
        same = [j for j, _, h in ROWS if (h or "") == (html or "") and j is not None]
        to = min(same) if same and len(b) >= 100 and min(same) != i else None
        want.append((i, len(b), hashlib.sha256(b).hexdigest(),
                     "response" if to is None else "revisit", to))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert warc.pages_to_warc(pages.where("page_id < 0")).count() == 0


def test_archives_give_back_payloads(spark, pages, tmp):
    warc.write_arc(pages, f"{tmp}/arc", 2)
    warc.arc_to_warc(spark, f"{tmp}/arc", f"{tmp}/warc")
    rows = warc.read_warc(spark, f"{tmp}/warc", payload=True).collect()
    by = {r.page_id: r for r in rows if r.record_type == "response"}
    assert bytes(by[3].payload).decode() == HTML and by[3].uri == "http://a/y%20z%0A"
    assert bytes(by[8].payload).decode() == ROWS[-1][2]


def test_arc_headers_of_both_versions():
    for version in (1, 2):
        raw = warc.arc_filedesc(version) + b"\n" + warc.arc_record(version, 61, "http://a", "é") + b"\n"
        raw = gzip.compress(raw[:90]) + gzip.compress(raw[90:])        # members may split anywhere
        (r,) = warc.parse_arc(raw)
        assert (r["page_id"], r["uri"], r["payload"], r["date"]) == (
            61, "http://a", "é".encode(), "20200101000101")
    with pytest.raises(ValueError):
        list(warc.parse_arc(gzip.compress(warc.arc_record(1, 1, "u", "abc")[:-2])))


def test_warc_digest_is_verified():
    rec = {"page_id": 1, "uri": "u", "ip": "0.0.0.0", "date": "20200101000000", "head": b"HTTP/1.0 200 OK",
           "payload": b"abc", "digest": "00", "refers_to": None}
    with pytest.raises(ValueError):
        list(warc.parse_warc(gzip.compress(warc.warc_record(rec) + b"\r\n\r\n")))


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>a="</p>"</script></head>
<body><header>H</header><nav><ul><li>m1<li>m2</ul></nav><div class="cookie-notice">ok?</div>
<div class="ad">buy</div><main><article><h1>Ti &amp; tle</h1><p><b>one<br>two<p>three&nbsp;%s</p>
<div class="box">Follow us</div><form><input><p>f</p></form><section id="comments"><p>c</p></section>
<ul><li>x<li>y</ul></article></main><aside>s</aside><footer>&copy; f</footer></body></html>"""


def test_extract_article_without_boilerplate():
    assert extract(PAGE % "q") == "Ti & tle\n\none two\n\nthree q\n\nFollow us\n\nx\n\ny"
    assert extract(None) == extract("") == "" and extract("a < b &lt; c") == "a < b < c"
    assert extract("<p>open <i>it</p> rest") == "open it\n\nrest"
    assert extract("<script>x</script><!-- n --><p>a\t\n b") == "a b"
    assert extract("<div>" * 3000 + "deep") == "deep"


def test_extract_keeps_articles_in_wrappers_and_named_headings():
    art = "<article><h1>T</h1><p>one</p></article>"
    for name in ("layout with-sidebar", "post has-comments", "sidebar", "page social"):
        assert extract(f"<body><div class='{name}'>x{art}</div></body>") == "T\n\none"
        assert extract(f"<body><div class='{name}'><main>{art}</main></div></body>") == "T\n\none"
    assert extract(f"<main><div class='post comments'>{art}</div></main>") == "T\n\none"
    assert extract("<article><h2 id='related-work'>Related</h2><h2 class='header'>H</h2><section "
                   "id='social-history'><p>s</p></section></article>") == "Related\n\nH\n\ns"
    assert extract("<body><div class='sidebar'><p>all</p></div></body>") == "all"
    # boxes still go, also beside the article
    assert extract(f"<div class='related'><article>teaser</article></div>{art}") == "T\n\none"
    assert extract("<article>a<div class='cookie-notice'>n</div><div class='ad-3'>n</div><section "
                   "id='comments'><article>c</article></section></article>") == "a"
    assert extract("<p>a</p><div class='share'>s</div>") == "a"


def test_extract_named_containers_go_hidden_text_stays():
    for name in ("comment-list", "comments-area", "reader-comments", "user-comments", "related-posts",
                 "share-buttons", "social-links", "ad-container", "cookie-bar", "newsletter-box",
                 "comment-section"):
        for attr in ("class='x1 ", "id='"):
            assert extract(f"<article><p>a</p><div {attr}{name}'><p>n</p></div></article>") == "a"
    for name in ("with-sidebar", "social-history", "post-header", "has-comments", "comment-on-law"):
        assert extract(f"<article><p>a</p><div class='{name}'>b</div></article>") == "a\n\nb"
    assert extract("<article>a<p hidden>b</p><p aria-hidden='true'>c</p><p style='display: none'>d"
                   "</p></article>") == "a\n\nb\n\nc\n\nd"


def test_extract_chooses_article_or_main_by_what_they_hold():
    assert extract("<main><p>Intro</p><article>card</article><p>Rest</p></main>") == \
        "Intro\n\ncard\n\nRest"
    assert extract("<article>one</article><article>two</article><main><p>The text itself</p></main>"
                   ) == "The text itself"
    assert extract("<main><p>by me</p><article>The text itself</article><div class='comments'>"
                   "<p>a comment longer than the text</p></div></main>") == "The text itself"


def test_extract_very_long_page():
    words = [f"w{i}" for i in range(200_000)]
    page = "<body><nav>m</nav><article>" + "".join(
        f"<p>{' '.join(words[i:i + 100])}</p>" for i in range(0, len(words), 100)) + "</article></body>"
    assert extract(page).split() == words


def test_tree_matching():
    a, b = parse("<ul><li>1<li>2<li>3</ul>"), parse("<ul><p>0</p><li>1<li>9</ul>")
    number(a), number(b)
    size, pairs = match(a, b)
    assert size == 4 == len(pairs) and all(x.tag == y.tag for x, y in pairs)
    big = parse("<ul>" + "<li>i" * 500 + "</ul>")
    assert match(big, big)[0] == 502


def test_tree_matching_of_long_lists_and_deep_trees():
    # one more paragraph at the front, a note at the end: the notes are still paired
    a = parse("<div>" + "<p>t</p><p><b>x</b></p>" * 100 + "<p>z<i>note</i></p><ul></ul></div>")
    b = parse("<div><p>n<em>e</em></p>" + "<p><b>x</b></p><p>t</p>" * 110 + "<p>z<i>note</i></p></div>")
    size, pairs = match(a, b)
    # root, div, 200 of the 201 p with an inner b or i, where these meet
    assert size == len(pairs) == 2 + 201 + 100 + 1 and size == reference_size(a, b)
    assert any(x.tag == "i" == y.tag for x, y in pairs)
    deep = [parse("<div>" * 900 + end) for end in ("<p>a<b>c</b>", "<ul></ul><p>a<b>c</b><i></i>")]
    assert match(*deep)[0] == 903
    rng = random.Random(3)
    for _ in range(60):
        t = [parse("".join(rng.choice(["<div>", "<ul>", "</div>", "<b>x</b>", "</ul>", "<li>", "<i>"])
                           for _ in range(rng.randrange(90)))) for _ in "ab"]
        n, pairs = match(*t)
        assert n == len(pairs) == reference_size(*t)
        assert len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs}) == n


def reference_size(a, b):
    """Simple tree matching as published, in plain recursion."""
    if a.tag != b.tag:
        return 0
    ka, kb = ([k for k in x.kids if not isinstance(k, str)] for x in (a, b))
    up = [0] * (len(kb) + 1)
    for x in ka:
        row = [0]
        for j, y in enumerate(kb):
            row.append(max(up[j + 1], row[j], up[j] + reference_size(x, y)))
        up = row
    return up[-1] + 1


def test_main_text_drops_what_a_host_repeats(spark):
    rng = random.Random(1)
    rows = [(i, f"http://h{i % 2}.example/{i}", PAGE % rng.random()) for i in range(24)]
    rows += [(24, None, PAGE % "lone"), (25, "http://h0.example/e", None), (None, "http://x/", ""),
             (26, "http://h1.example/z", "no tags"), (3, rows[3][1], rows[3][2])]
    df = spark.createDataFrame([(*r, "d", 1, 2, "h") for r in rows], PAGES).repartition(4)
    got = main_text(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    for i in range(24):
        # the heading is the same on all pages too; what varies is the slot
        assert "Follow us" not in by[i] and by[i].startswith("three") or "three" in by[i]
    assert "Follow us" in by[24] and by[25] == "" and by[26] == "no tags" and by[None] == ""
    salted = main_text(df, broadcast_bytes=0).collect()
    assert sorted(map(tuple, salted), key=repr) == sorted(map(tuple, got), key=repr)
    assert main_text(df.where("page_id < 0")).count() == 0


def test_main_text_of_a_host_with_two_layouts(spark):
    rng = random.Random(2)

    def page(i):
        text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(5))
        more = "<p>more</p>" * rng.randrange(3)
        if i % 5 < 2:
            return (f"<body><div>Top</div><ul><li>Sort by date</li><li>{text}</li></ul>{more}"
                    "<div>List end</div></body>")
        return (f"<body><div>Top</div><section><h2>Filed under news</h2><p>{text}</p>{more}</section>"
                "<div>Read on</div></body>")

    rows = [(i, f"http://two.example/{i}", page(i)) for i in range(40)]
    rows += [(40, "http://two.example/odd", "<body><table><tr><td>lone</td></tr></table></body>")]
    df = spark.createDataFrame([(*r, "d", 1, 2, "h") for r in rows], PAGES).repartition(4)
    by = {r.page_id: r.text for r in main_text(df).collect()}
    assert len(by) == 41 and by[40] == "lone"
    for i in range(40):
        assert not any(x in by[i] for x in ("Top", "Sort by", "List end", "Filed", "Read on")), by[i]
        assert len([x for x in by[i].split() if x[0] == "w"]) == 5


def test_main_text_counts_all_shapes_of_a_host(spark):
    """A layout whose shapes are rarer than a thousand others is still told apart."""
    def name(i):
        return "".join(chr(97 + i // 26 ** k % 26) for k in range(3))

    rows = []
    for i in range(2200):
        rows.append((i, f"http://many.example/{i}",
                     f'<body><div>Top</div><section class="v{name(i // 2)}"><h2>Filed under news</h2>'
                     f"<p>w{i}</p></section><div>Read on</div></body>"))
    for i in range(2200, 2208):
        rows.append((i, f"http://many.example/{i}",
                     f'<body><ul class="l{name(i)}"><li>Sort by date</li><li>w{i}</li></ul>'
                     "<table><tr><td>List end</td></tr></table></body>"))
    df = spark.createDataFrame([(*r, "d", 1, 2, "h") for r in rows], PAGES).repartition(4)
    by = {r.page_id: r.text for r in main_text(df).collect()}
    assert by == {i: f"w{i}" for i in range(2208)}
