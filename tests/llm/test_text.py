"""Operators 11, 12 and 13 against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from ludora.llm import queries, ranking, variants
from ludora.llm.html_text import Page, main_text
from ludora.llm.ranking import BlockIndex, Query, ranked_search
from ludora.llm.variants import spelling_variants

from .data import documents, words

SF = "/root/testdata/sf0.001"

# ---- operator 11


def kept(html: str) -> list[str]:
    page = Page(html)
    return [b[0] for b, k in zip(page.blocks, page.kept(), strict=True) if k]


@pytest.mark.parametrize(("html", "want"), [
    ("", []),
    ("<p>a &amp; b&nbsp; c<p>d<br>e<ul><li>1<li>2</ul>", ["a & b c", "d e", "1", "2"]),
    ("<article><header><h1>T</h1><p>by x</p></header><p>t <a href='a>b'>z</a>q</p><div class='share-bar'>s</div></article><p>out</p>", ["T", "t zq"]),
    ("<main><p>x</p><section id=comments><article><p>c</p></article></section></main>", ["x"]),
    ("<body class='has-sidebar'><div class='with-sidebar'><p>in</p></div><p hidden>h</p><form>f</form><aside>g</aside>", ["in"]),
    ("<div role=navigation>n</div><div class='cookieNotice'>c</div><div id=site-footer>f</div>text", ["text"]),
    ("a < b and 1 <2", ["a < b and 1 <2"]),
    ("<script>if (a<b) '</p>'</script><style>p{}</style><!-- <p>no --><p>yes</p><![CDATA[x]]>", ["yes"]),
    ("<table><tr><td>a<td>b<tr><td>c</table><p>tail <b>bold", ["a", "b", "c", "tail bold"]),
    ("<p>cut off <a href=\"x", ["cut off"]),
    ("x</div></p></b>y", ["x", "y"]),
])
def test_page(html, want):
    assert kept(html) == want


class Plain(HTMLParser):
    """Text blocks of an `article` with paragraphs and headings, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.out = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in ("article", "p", "h1"):
            self.out.append("")
        elif tag == "br":
            self.out[-1] += " "

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        if tag in ("p", "h1"):
            self.out.append("")

    def handle_data(self, data):
        if self.inside:
            self.out[-1] += data


def test_main_text_on_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in main_text(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        plain = Plain()
        plain.feed(r.html)
        want = "\n\n".join(t for t in (" ".join(x.split()) for x in plain.out) if t)
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


def article(k: int) -> str:
    rng = random.Random(k)
    return "".join(f"<p>{words(rng, 30)}</p>" for _ in range(3))


def site() -> list[tuple]:
    """Hosts with and without a template, copies of one article, and awkward rows."""
    menu, box = "<div><a href=/>Home</a> <a href=/x>News</a></div>", "<div><p>Read our new book of birds today.</p></div>"
    quote = "<p>a quoted passage</p>"
    rows = []
    for k in range(8):  # no article element: template blocks can only be found by counting
        rows.append((k, f"http://User@A.example:80/{k}", f"<body>{menu}{article(k)}{box}", article(k)))
    for k in range(8, 16):  # another host has too few of the same
        rows.append((k, f"http://b{k % 3}.example/", f"<body>{menu}{article(k)}", "<p>Home News</p>" + article(k)))
    for k in range(16, 30):  # copies of one article on a host
        rows.append((k, f"http://c.example/{k}", f"<body><p>unlike {k}</p>{article(99)}", f"<p>unlike {k}</p>" + article(99)))
    for k in range(30, 40):  # a box in articles goes, a quoted paragraph stays
        rows.append((k, f"http://d.example/{k}", f"<article>{article(k)}{box}{quote}</article><div>z</div>", article(k) + quote))
    rows += [(k, None, f"<body>{menu}{article(k)}", article(k)) for k in range(40, 46)]
    rows += [(50, "no url", None, ""), (None, "http://a.example/", "", ""), (50, "http://a.example/", "<nav>x</nav>", ""), (51, "http://a.example/", f"<p>{'long ' * 300_000}</p>", f"<p>{'long ' * 300_000}</p>")]
    return rows


def test_templates(spark):
    rows = site()
    random.Random(1).shuffle(rows)
    pages = spark.createDataFrame([(*r[:3], "clash", 7, "x") for r in rows], "page_id long, url string, html string, row string, hash long, text string").repartition(5)
    got = sorted((tuple(r)[:4] for r in main_text(pages).collect()), key=repr)
    texts = [("\n\n".join(" ".join(t.split()) for t in re.findall("<p>(.*?)</p>", r[3], re.S))) for r in rows]
    assert got == sorted(((r[0], r[1], t, len(t)) for r, t in zip(rows, texts, strict=True)), key=repr)
    assert main_text(pages.limit(0)).collect() == []


# ---- operator 12


def brute_ranks(docs, items, top=20):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t.translate({c: c + 32 for c in range(65, 91)}))
    texts = [(i, Counter(w)) for i, t in docs if t and (w := split(t))]
    n_docs, length = len(texts), sum(c.total() for _, c in texts)
    df = Counter(w for _, c in texts for w in c)
    out = []
    for item, text in items:
        scores = []
        asked = split(text or "")
        for i, c in texts:
            m = 75 + 25 * c.total() * n_docs // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 12 * m)) for w in asked if c[w])
            if s:
                scores.append((-s, ranking.NO_ID if i is None else i))
        out += [(item, k + 1, None if i == ranking.NO_ID else i, -s) for k, (s, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("block", "item_bytes"), [(1 << 14, 1 << 22), (7, 1 << 22), (16, 600)])
def test_ranks(spark, monkeypatch, block, item_bytes):
    monkeypatch.setattr(ranking, "BLOCK_DOCS", block)
    monkeypatch.setattr(ranking, "ITEM_BYTES", item_bytes)
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rng = random.Random(5)
    texts = [" ".join(rng.sample(t.split(), min(len(t.split()), 12))) for _, t in rows[:25] if t]
    items = [(k, t) for k, t in enumerate(texts)] + [(100, None), (101, ""), (102, "ab AB aB zzz"), (103, "É é ünï x,y"), (0, texts[3]), (None, texts[4])]
    frame = spark.createDataFrame([(*i, "clash", 1.0) for i in items], "item_id long, text string, doc_id string, score double")
    got = sorted((tuple(r) for r in ranked_search(docs, frame).collect()), key=repr)
    assert got == brute_ranks(rows, items)


def test_ranks_of_nothing(spark):
    docs, items = documents(spark), spark.createDataFrame([(1, "ab")], "item_id long, text string")
    assert ranked_search(docs.limit(0), items).collect() == []
    assert ranked_search(docs, items.limit(0)).collect() == []
    assert ranked_search(docs.where("text is null"), items).collect() == []


def test_bounds():
    """Pair bounds hold for every document, are never above the sum of maxima, and are below it somewhere."""
    rng = np.random.default_rng(4)
    tighter = 0
    for _ in range(60):
        n, t = 60, 8
        terms, places = (x.ravel() for x in np.meshgrid(np.arange(t), np.arange(n)))
        keep = rng.random(n * t) < rng.random(t)[terms] * 0.7
        terms, places = terms[keep], places[keep]
        impacts = rng.integers(1, 1000, len(terms))
        weights = rng.integers(0, 50, t)
        query = Query({k: int(rng.integers(1, 4)) for k in range(t)}, weights)
        block = BlockIndex(np.arange(n) * 3, terms, places, impacts, set(query.pairs()), 5)
        present = [k for k in query.terms if k in block.lists]
        repeats = dict(zip(query.terms, query.repeats, strict=True))
        table = np.zeros((n, t), np.int64)
        table[places, terms] = impacts
        bounds, most = block.bounds(query, present), 0
        for k in range(len(present) + 1):
            reached = sum((repeats[x] * table[:, x] for x in present[:k]), np.zeros(n, np.int64))
            most = sum(repeats[x] * block.lists[x].most for x in present[:k])
            assert reached.max() <= bounds[k] <= most
            tighter += bounds[k] < most
        score = sum((repeats[x] * table[:, x] for x in present), np.zeros(n, np.int64))
        want = sorted((-s, i * 3) for i, s in enumerate(score) if s)[:5]
        got = ranking.best(*block.search(query, 1, 5), 5)
        assert want == [(-s, i) for s, i in zip(got[0].tolist(), got[1].tolist(), strict=True)]
    assert tighter > 100


# ---- operator 13


def brute_variants(rows):
    found = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1:]
            found[w] += 1
    n = {w: k for w, k in found.items() if len(w) >= 5 and k >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    form, count = {}, {}
    for w in n:
        others = [x for x in n if near(w, x)]
        count[w] = len(others)
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted(((w, form[w], root(w), n[w], count[w], n.get(form[w])) for w in n), key=repr)


def variant_rows() -> list[tuple]:
    rng = random.Random(11)
    bases = ["".join(rng.choice("abé") for _ in range(rng.randint(4, 8))) for _ in range(25)]
    out = []
    for i in range(160):
        text = []
        for _ in range(60):
            w = rng.choice(bases[: rng.randint(1, 25)])
            k = rng.randrange(len(w))
            text.append(rng.choice([w, w, w.upper(), w[:k] + w[k + 1:], w[:k] + rng.choice("abÿ") + w[k:], w[:k] + rng.choice("abÀ") + w[k + 1:]]))
        out.append((i, rng.choice([" ", "-", "1", "\n"]).join(text)))
    return [*out, (None, out[0][1]), (None, None), (3, ""), (3, out[3][1]), (1, "aaaaaaa " * 9 + "aaaaaa " * 4 + "aaaaaaaa " * 3), (7, "x" * 300_000 + " œœœœœ" * 5)]


@pytest.mark.parametrize("batch", [10_000, 3])
def test_variants(spark, batch):
    rows = variant_rows()
    docs = spark.createDataFrame([(*r, "clash", 5) for r in rows], "doc_id long, text string, word string, n long").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = sorted((tuple(r) for r in spelling_variants(docs).collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = brute_variants(rows)
    assert got == want
    assert sum(r[1] is not None for r in want) > 50 and any(r[1] and r[2] != r[1] for r in want)


def test_variants_of_nothing(spark):
    docs = documents(spark)
    assert spelling_variants(docs.limit(0)).collect() == []
    assert spelling_variants(docs.where("text is null")).collect() == []


def test_rotations(spark):
    rows = variants.rotations(spark.createDataFrame([("aab", 3)], "word string, n long")).collect()
    assert sorted((r.prefix, r.skipped, r.leads) for r in rows) == sorted(
        [("aab$", "", False), ("ab$a", "", False), ("b$aa", "", False), ("$aab", "", False), ("ab$", "a", True), ("b$a", "a", False), ("$aa", "b", True)])


@pytest.mark.parametrize("name", ["op11_html_extraction", "op12_ranked_search", "op13_spelling_variants"])
def test_query(spark, name):
    out = queries.QUERIES[name][0](spark, SF)
    want = {"op11_html_extraction": ["page_id", "url", "text", "n_chars"], "op12_ranked_search": ["item_id", "rank", "doc_id", "score"], "op13_spelling_variants": ["word", "form", "root", "n", "n_near", "form_n"]}
    assert out.columns == want[name]
    assert out.agg(F.count("*")).first()[0] > 0
