import random
from html.parser import HTMLParser

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from nightjar.llm import html_extract as he
from nightjar.llm import hamming_search as hs
from nightjar.llm import url_filter as uf

LONG = "The house of the man was on the hill and it was as old as the town that lay in the valley by the river. "
PARA = LONG * 3


def test_main_text_of_a_marked_article():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
    <header>Site</header><nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="cookie-notice">We use cookies.</div>
    <aside class="sidebar"><p>{PARA}</p></aside>
    <article><h1>Title &amp; more</h1><p>{PARA}</p><p>Short.<br>Line<!-- c --> two &lt;x&gt;</p>
    <div class="ad">Buy</div><ul><li>One</li><li>Two</li></ul><section class="comments"><p>{PARA}</p></section></article>
    <form><label>Name</label></form><footer>&copy; me</footer></body></html>"""
    want = ["Title & more", PARA.strip(), "Short.", "Line two <x>", "One", "Two"]
    assert he.main_text(page).split("\n") == want


def test_two_passes_without_a_marked_part():
    links = "".join(f'<li><a href="/{i}">Entry number {i}</a></li>' for i in range(8))
    page = f"<div><ul>{links}</ul></div><h2>Heading</h2><p>{PARA}</p><p>Yes.</p><p>{PARA}</p>" \
           f"<div id='footer'><p>{PARA}</p></div><p>Imprint</p>"
    assert he.main_text(page).split("\n") == ["Heading", PARA.strip(), "Yes.", PARA.strip()]


SOURCE = '<p>Source: <a href="/r">Reuters news agency</a></p>'
ITALIAN = "Il vecchio ponte attraversa ancora oggi quel fiume dove ogni mattina passano centinaia di lavoratori. " * 5


@pytest.mark.parametrize("paragraphs", [[LONG.strip()] * 2, [ITALIAN.strip()] * 2, ["Короткий рассказ о городе. " * 12 + "x"]])
def test_links_in_a_marked_article_drop_nothing(paragraphs):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    page = f"<nav><p>{PARA}</p></nav><article><h1>T</h1>{body}{SOURCE}<ul><li><a href='/x'>More</a></li></ul>" \
           "<p class='share'><a href='/s'>Share</a></p></article><p>Imprint</p>"
    assert he.main_text(page).split("\n") == ["T", *paragraphs, "Source: Reuters news agency", "More"]


MENU = "<ul><li><a href='/1'>One</a></li><li><a href='/2'>Two</a></li><li><a href='/3'>Three</a></li></ul>"


@pytest.mark.parametrize("page,want", [
    (f"<article><p data-widget-id='share'>{PARA}</p><div data-id=\"side-1\">b</div><p title='x class=ad'>c</p></article>",
     [PARA.strip(), "b", "c"]),
    (f"<article><section class='search-for-meaning'><p>{PARA}</p></section><p id='noticeBar'>n</p></article>", [PARA.strip()]),
    (f"<div class='no-sidebar'><p>{PARA}</p></div><div class='main side-by-side'><p>{PARA}</p></div>", [PARA.strip()] * 2),
    (f"<div class='site-footer x'><p>{PARA}</p></div><div class='ad-728x90'>{PARA}</div><p>{PARA}</p>", [PARA.strip()]),
    (f"<article><p class=\"x>{PARA}</p><p class=\"y\">More</p></article>", [PARA.strip(), "More"]),
    ("<article><p>a <math><mi>x</mi></math> b <object>alt</object></p></article>", ["a x b alt"]),
    (f"<div><p>{ITALIAN}</p><p>{ITALIAN}</p></div>", [ITALIAN.strip()] * 2),
    ("<p>One.</p><p>Two.</p><nav>Menu</nav>", ["One.", "Two."]),
    (f"<article><h1>T</h1>{MENU}<p>Go on</p>{MENU}<p>{PARA}</p><p>End.</p></article>", ["T", PARA.strip(), "End."]),
    (f"<article>{MENU}</article>", ["One", "Two", "Three"]),
    (f"<article><p>{PARA}</p><div class='comments'><article><p>{PARA}</p></article></div></article>", [PARA.strip()]),
    (f"<article><p>{PARA}</p></article><article class='comment'><p>{PARA}</p></article>", [PARA.strip()])])
def test_marks_veto_and_the_passes_decide_the_rest(page, want):
    assert he.main_text(page).split("\n") == want


def test_depth_and_length_of_a_page_cost_in_proportion():
    assert he.main_text("<div>" * 30000 + "x" + "</div>" * 30000) == "x"
    assert he.main_text("<p class=\"x>" * 20000 + "end") == "end"
    text = (LONG * 20000).strip()                              # 2 MB in one block
    assert he.main_text(f"<article><p>{text}</p></article>") == text


class Plain(HTMLParser):
    """Blocks of well-formed pages as (text, linked characters, marked, in main, heading)."""

    def __init__(self):
        super().__init__()
        self.path, self.parts, self.out = [], [], []

    def flush(self):
        text = " ".join("".join(t for t, _ in self.parts).split())
        tags = [t for t, _ in self.path]
        if text and not {"script", "style", "title"} & set(tags):
            linked = sum(len(" ".join(t.split())) for t, a in self.parts if a)
            barred = any(t in ("nav", "footer", "aside") or c == "ad" for t, c in self.path)
            self.out.append((text, linked, barred, "article" in tags, "h1" in tags or "h2" in tags))
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag not in ("a", "b"):
            self.flush()
            if tag == "p" and "p" in [t for t, _ in self.path]:
                self.handle_endtag("p")
        if tag not in ("br", "meta", "link"):
            self.path.append((tag, dict(attrs).get("class")))

    def handle_endtag(self, tag):
        if tag not in ("a", "b"):
            self.flush()
        if tag in [t for t, _ in self.path]:
            last = max(i for i, (t, _) in enumerate(self.path) if t == tag)
            self.path = self.path[:last] if tag not in ("a", "b") else self.path[:last] + self.path[last + 1:]

    def handle_data(self, data):
        self.parts.append((data, any(t == "a" for t, _ in self.path)))


def plain_text(page):
    """The rules written out block by block, neighbours by walking outward."""
    p = Plain()
    p.feed(page)
    p.close()
    p.flush()
    blocks = p.out
    has_main = any(m and not x for _, _, x, m, _ in blocks)
    blocks = [(t, k, x or has_main and not m, m, h) for t, k, x, m, h in blocks]
    is_link = [m and not x and len(t) < 70 and k >= .9 * len(t) for t, k, x, m, _ in blocks]

    def kind(i):
        text, linked, barred, main, _ = blocks[i]
        lo, hi = i, i
        while lo and is_link[lo - 1]:
            lo -= 1
        while hi + 1 < len(blocks) and is_link[hi + 1]:
            hi += 1
        if barred or is_link[i] and hi - lo >= 2:
            return "bad"
        if linked > .2 * len(text) or len(text) < 70:
            return "bad" if linked and not main else "short"
        words = [w.strip(".,;:!?\"'()") for w in text.lower().split(" ")]
        stop = sum(w in he.STOP_WORDS for w in words) / len(words)
        if stop >= .32 and len(text) > 200:
            return "good"
        return "near" if stop >= .3 or main else "bad" if stop < .05 else "short"

    kinds = [kind(i) for i in range(len(blocks))]
    if "good" not in kinds:
        free = [i for i, (t, k, x, _, _) in enumerate(blocks) if not x and k <= .2 * len(t)]
        tall = [i for i in free if len(blocks[i][0]) >= 70]
        for i in tall:
            kinds[i] = "good" if len(blocks[i][0]) > 200 else "near"
        for i in free:
            if not tall and kinds[i] == "short":
                kinds[i] = "good"

    def nearest(i, step):
        j = i + step
        while 0 <= j < len(blocks):
            if kinds[j] in ("good", "bad") and not (has_main and blocks[j][2]):
                return kinds[j], abs(i - j)
            j += step
        return None, 0

    kept = []
    for i, (text, *_, heading) in enumerate(blocks):
        (a, da), (b, db) = nearest(i, -1), nearest(i, 1)
        sides = {a, b} - {None}
        if kinds[i] in ("good", "bad"):
            keep = kinds[i] == "good"
        elif not sides:
            keep = has_main or kinds[i] == "near"
        elif has_main:
            keep = kinds[i] == "near" or not a == b == "bad"
        elif len(sides) == 1:
            keep = sides == {"good"}
        else:
            keep = kinds[i] == "near" or heading and b == "good" or (a if da <= db else b) == "good"
        if keep:
            kept.append(text)
    return "\n".join(kept or [t for t, _, x, _, _ in blocks if has_main and not x])


def test_given_pages_equal_the_rules_written_out():
    for page in pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"])["html"].to_pylist():
        assert he.main_text(page) == plain_text(page)


@pytest.mark.parametrize("main", [True, False])
def test_invented_pages_equal_the_rules_written_out(main):
    r = random.Random(11)
    kinds = [lambda: f"<p>{LONG * r.randint(1, 4)}</p>", lambda: f"<p>{ITALIAN}</p>", lambda: f"<p>{ITALIAN[:90]}</p>",
             lambda: "<p>Short one.</p>", lambda: "<h2>Heading</h2>", lambda: "<p>See <a href='/x'>this other page</a></p>",
             lambda: "<p><a href='/x'>Link</a></p>", lambda: MENU, lambda: f"<div class='ad'>{LONG * 3}</div>",
             lambda: "<nav>Menu</nav>", lambda: "<p>Il the ponte attraversa quel fiume ogni mattina passano sempre molti uomini.</p>"]
    for _ in range(400):
        some = r.sample(kinds, r.randint(1, len(kinds)))
        page = "".join(r.choice(some)() for _ in range(r.randint(1, 12)))
        page = f"<p>Before</p><article>{page}</article><p>After</p>" if main else page
        assert he.main_text(page) == plain_text(page), page


@pytest.mark.parametrize("page,text", [(None, ""), ("", ""), ("plain " * 40, ("plain " * 40).strip()), ("<p", ""),
                                       ("<script>never closed", ""), ("<p>a &nbsp; b</p>", "a b")])
def test_odd_pages(page, text):
    assert he.main_text(page) in (text, "")


def test_extract_keeps_rows_and_counts_code_points(spark):
    rows = [(1, "u", f"<article><p>é{PARA}</p></article>", "x"), (2, None, None, "x"), (None, "u", "", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in he.extract(df).collect()}
    assert got[1][2] == len(got[1][1]) == len(PARA) and got[2] == (None, "", 0) and got[None] == ("u", "", 0)
    assert he.extract(df.limit(0)).count() == 0


URLS = ["https://A.Example.org/en/12?x#y", "http://example.org/es/1", "http://sub.example.org/de/", "http://x.com/fr/a",
        "http://x.com/de/a", "http://x.com/en/a", "http://x.net", "http://x.net?q=/", "no url", None, "a://b://c/d",
        "http://notexample.org/es/1"]
WANT = [("a.example.org", "/en/12", "example.org/en/1", "block"), ("example.org", "/es/1", "example.org/es/", "block"),
        ("sub.example.org", "/de/", "org/", "allow"), ("x.com", "/fr/a", "com/fr/", "allow"),
        ("x.com", "/de/a", "com/de/", "block"), ("x.com", "/en/a", None, "allow"), ("x.net", "", None, "allow"),
        ("x.net", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("b:", "//c/d", None, "allow"),
        ("notexample.org", "/es/1", "org/", "allow")]


def test_rules_hosts_and_paths(spark):
    df = spark.createDataFrame([(i, u, "<a href='/x'>") for i, u in enumerate(URLS)],
                               "page_id long, url string, html string").withColumn("host", F.lit(1))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in uf.filter_urls(df).collect()}
    assert [got[i] for i in range(len(URLS))] == WANT
    assert uf.filter_urls(df.limit(0)).count() == 0


def test_links_spread_trust_and_distrust(spark):
    rules = (uf.Rule("good.org", "/", "allow"), uf.Rule("bad.com", "/", "block"))
    link = lambda *h: "".join(f'<a href="https://{x}/p?q">x</a>' for x in h)
    rows = [(1, "http://good.org/a", link("near.net", "WWW.near.net")), (2, "http://near.net/a", link("far.net")),
            (3, "http://bad.com/a", link("near.net")), (4, "http://spam.net/a", link("bad.com", "mix.net")),
            (5, "http://farm.net/a", link("spam.net")), (6, "http://far.net/", None), (7, "http://alone.net/", ""),
            (8, "http://mix.net/", link("good.org"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in uf.filter_urls(df, rules).collect()}
    assert got == {1: "allow", 2: "allow", 3: "block", 4: "block", 5: "block", 6: "allow", 7: "allow", 8: "allow"}


def test_propagation_equals_dense_pagerank(spark):
    r = np.random.default_rng(4)
    n = 12
    edges = sorted({(f"h{a}", f"h{b}") for a, b in r.integers(0, n, (40, 2)).tolist() if a != b})
    seeds = {0: {"h0": .5, "h1": .5}, 1: {"h2": 1.0}}
    e = spark.createDataFrame(edges, "src string, dst string")
    s = spark.createDataFrame([(k, h, w) for k, d in seeds.items() for h, w in d.items()], "kind int, host string, seed double")
    got = {(x.kind, x.host): x.rank for x in uf.propagate(e, s, tolerance=1e-10, max_rounds=150).collect()}
    for kind in (0, 1):
        m = np.zeros((n, n))
        for a, b in edges:
            a, b = (int(a[1:]), int(b[1:])) if kind == 0 else (int(b[1:]), int(a[1:]))
            m[a, b] = 1
        seed = np.array([seeds[kind].get(f"h{i}", 0.0) for i in range(n)])
        p = np.array([row / row.sum() if row.sum() else seed for row in m])
        rank = seed.copy()
        for _ in range(300):
            rank = (1 - uf.DAMPING) * seed + uf.DAMPING * rank @ p
        assert np.allclose([got.get((kind, f"h{i}"), 0.0) for i in range(n)], rank, atol=1e-6)


def test_propagation_reaches_far_hosts_with_the_production_values(spark):
    n = 26                                                     # a line of hosts, each with a way back
    line = [(f"h{i + 1}", f"h{i}") for i in range(n - 1)] + [("h0", f"h{i}") for i in range(1, n)]
    e = spark.createDataFrame(line, "src string, dst string").coalesce(1)
    s = spark.createDataFrame([(1, "h0", 1.0)], "kind int, host string, seed double").coalesce(1)
    conf = {"spark.sql.shuffle.partitions": "1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = {x.host: x.rank for x in uf.propagate(e, s).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    m = np.diag(np.full(n - 1, 0.5), 1)
    m[:, 0] = 0.5
    m[0, :2] = 0, 1
    m[n - 1, 0] = 1
    rank = np.eye(n)[0]
    for _ in range(1000):
        rank = (1 - uf.DAMPING) * np.eye(n)[0] + uf.DAMPING * rank @ m
    assert np.allclose([got.get(f"h{i}", 0.0) for i in range(n)], rank, rtol=1e-5, atol=0)


def test_propagation_says_when_it_has_not_settled(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "a")], "src string, dst string")
    s = spark.createDataFrame([(0, "a", 1.0)], "kind int, host string, seed double")
    with pytest.raises(RuntimeError):
        uf.propagate(e, s, max_rounds=3)


@pytest.mark.parametrize("m", [None, 4])
def test_search_equals_brute_force(spark, m):
    r = np.random.default_rng(9)
    v = r.normal(size=(220, 64))
    v[100:180] = v[100]                                        # one vector holds a third of the rows
    rows = [(i, [float(x) for x in e], "x") for i, e in enumerate(v)] + [(220, None, "x"), (3, [float(x) for x in v[3]], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    if m:
        codes = df.where("embedding IS NOT NULL").select(F.col("vec_id").alias("id"),
                                                         hs.sign_code(F.col("embedding")).alias("code")).distinct()
        assert hs.top_k(codes, codes.where("id % 50 = 0").select("code"), 10, m).count() == 40    # two queries share a code
        return
    got = {}
    for x in hs.search(df).collect():
        got.setdefault(x.query_id, {})[x.rank] = (x.distance, x.vec_id)
    bits = v > 0
    for q in range(0, 220, 50):
        want = sorted((int((bits[i] != bits[q]).sum()), i) for i in range(220))[:10]
        assert [got[q][k] for k in range(1, 11)] == want
    assert hs.search(df.limit(0)).count() == 0
    few = hs.search(df.where("vec_id IN (0, 1)")).collect()
    assert len(few) == 2 and few[0].query_id == 0


@pytest.mark.parametrize("m", [2, 4, 8])
def test_rounds_of_every_segment_count_equal_brute_force(spark, m):
    r = random.Random(m)
    centres = [r.getrandbits(64) for _ in range(4)]
    codes = {}
    for i in range(300):                                   # crowded segments, equal codes and ties
        c = centres[i % 4]
        for _ in range(r.randint(0, 3)):
            c ^= 1 << r.randrange(20)                      # the upper segments stay those of the centre
        codes[i] = c
    signed = {i: c - (1 << 64) if c >> 63 else c for i, c in codes.items()}
    df = spark.createDataFrame(list(signed.items()), "id long, code long").repartition(3)
    got = {}
    for x in hs.top_k(df, df.where("id % 50 = 0").select("code"), 5, m).collect():
        got.setdefault(x.q, {})[x["rank"]] = (x.dist, x.id)
    for q in range(0, 300, 50):
        want = sorted(((codes[i] ^ codes[q]).bit_count(), i) for i in codes)[:5]
        assert [got[signed[q]][k] for k in range(1, 6)] == want


def test_hamming_rows_without_ids_or_vectors_and_null_elements(spark):
    v = [1.0, -1.0] * 32
    rows = [(None, v), (50, None), (0, v), (0, v), (1, [None] + v[1:]), (2, [-x for x in v]), (3, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS code", "'x' AS seg")
    got = [(x.query_id, x["rank"], x.vec_id, x.distance) for x in hs.search(df).collect()]
    assert sorted(got) == [(0, 1, 0, 0), (0, 2, 1, 1), (0, 3, 3, 32), (0, 4, 2, 64)]
