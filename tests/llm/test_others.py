"""Operators 1, 3, 6, 8 and 9, the pipeline and the registered queries."""

from __future__ import annotations

import hashlib
import math
import random
import re
from base64 import b32encode
from collections import Counter, defaultdict
from zlib import crc32

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ludora.llm import queries
from ludora.llm.decontam import contained_items, decontaminate
from ludora.llm.mixing import mix
from ludora.llm.quality import BLOCK, WIDTH, fit_quality, quality_scores, train
from ludora.llm.toxicity import BlockMaxIndex, fit_toxicity, toxicity_scores
from ludora.llm.warc import read_warc, write_warc

from .data import SCHEMA, documents, rows

SF = "/root/testdata/sf0.001"


def bag(values):
    return sorted(values, key=repr)


PAGES = [(k, f"http://h/{k}", f"<p>{k % 7}</p>" * (k % 5 * 40)) for k in range(60)] + [(70, None, None), (71, "http://x/\r\nWARC-Type: é", "ü"), (None, "n", "<p>only</p>"), (None, "n", "<p>3</p>" * 120), (59, "http://again", PAGE := "<p>3</p>" * 160), (80, "u", PAGE), (80, "v", PAGE)]


@pytest.mark.parametrize("shard_bytes, least", [(1 << 30, 0), (2000, 0), (2000, 100)])
def test_warc_round_trip(spark, tmp_path, shard_bytes, least):
    pages = spark.createDataFrame([(*p, "clash", 1) for p in PAGES], "page_id long, url string, html string, digest string, shard int")
    path = f"file://{tmp_path}/w"
    manifest = write_warc(pages, path, "page_id", "url", "html", shard_bytes, 1500, least).collect()
    last: dict = {}
    for k, _, html in PAGES:
        body = (html or "").encode()
        if k is not None:
            last[body] = max(k, last.get(body, k))
    want = []
    for k, _, html in PAGES:
        body = (html or "").encode()
        revisit = len(body) >= least and body in last and last[body] != k
        want.append((k, len(body), b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if revisit else "response", last[body] if revisit else None))
    got = read_warc(spark, path)
    assert bag((r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()) == bag(want)
    assert sum(m.records for m in manifest) == len(PAGES) and all(m.size <= 1500 or m.records == 1 for m in manifest)
    assert sorted(f.name for f in (tmp_path / "w").glob("*.gz")) == sorted(m.name for m in manifest)
    again = write_warc(pages.orderBy("html").repartition(3), f"file://{tmp_path}/v", "page_id", "url", "html", shard_bytes, 1500, least).collect()
    assert bag((m.name, m.sha256) for m in again) == bag((m.name, m.sha256) for m in manifest)


def test_warc_empty(spark, tmp_path):
    write_warc(spark.createDataFrame([], "page_id long, url string, html string"), f"file://{tmp_path}/e", "page_id", "url", "html")
    assert read_warc(spark, f"file://{tmp_path}/e").count() == 0


def test_containment(spark):
    docs, passage = documents(spark), rows()[-1][1]
    items = [(1, passage.upper()), (2, " ".join(passage.split()[:20])), (3, "a b c"), (4, "ab"), (5, None), (6, "never seen words in here at all"), (None, passage), (7, " ".join(passage.split()[:20] + ["q", "r"])), (8, " ".join(passage.split()[:9] + ["q", "r", "s", "t"]))]

    def shingles(t, n):
        w = t.lower().encode().split()
        return {b" ".join(w[k: k + n]) for k in range(len(w) - n + 1)}

    want = []
    for i, t, *_ in rows():
        for item, text in items:
            n = min(5, len((text or "").split()))
            of = shingles(text, n) if n else set()
            found = len(of & shingles(t or "", n)) if of else 0
            if of and found >= 0.8 * len(of):
                want.append((i, item, len(of), found))
    table = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in contained_items(docs, table).collect()]
    assert len(want) > 50 and bag(got) == bag(want)
    assert decontaminate(docs, table).columns == docs.columns
    clean = decontaminate(docs, table.where("item_id = 3")).count()
    assert clean == len(rows()) - sum(w[1] == 3 for w in want)
    assert contained_items(docs, table.limit(0)).count() == 0 and contained_items(documents(spark, 0), table).count() == 0


def test_cnn_scores_whole_texts_like_brute_force():
    rng = np.random.default_rng(1)
    chunks = rng.integers(97, 110, (60, 2 * BLOCK + WIDTH - 1)).astype(np.uint8)
    labels = (np.arange(60) % 2).astype(np.float32)
    chunks[labels == 0, 100:110] = ord("!")
    model = train(chunks, labels, np.ones(60, np.float32), epochs=6)

    def brute(text: bytes) -> float:
        n = max(1, len(text))
        data = np.frombuffer(text.ljust(n + WIDTH - 1, b"\0") if len(text) < n + WIDTH - 1 else text, np.uint8)
        out = np.array([sum(model.table[w, data[p + w]] for w in range(WIDTH)) for p in range(n)])
        blocks = [out[a: a + BLOCK].max(axis=0) for a in range(0, n, BLOCK)]
        pairs = [np.maximum(a, b) for a, b in zip(blocks, blocks[1:], strict=False)] or blocks
        return 1 / (1 + np.exp(-np.mean([model.logits(p[None])[0] for p in pairs])))

    texts = [b"", b"a", b"ab!" * 100, bytes(rng.integers(97, 110, 3 * BLOCK + 5).astype(np.uint8)), b"!" * BLOCK, b"q" * (200 * BLOCK + 3)]
    assert np.allclose(model.score(texts), [brute(t) for t in texts], atol=1e-4)
    assert model.score([]).shape == (0,)


@pytest.fixture(scope="module")
def labelled(spark):
    base = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")


def test_quality_held_out(spark, labelled):
    docs, labels = labelled
    model = fit_quality(docs, labels)
    out = quality_scores(docs, model).join(labels, "doc_id").collect()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in out)
    held = [r for r in out if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.9
    odd = quality_scores(documents(spark), model).collect()
    assert len(odd) == len(rows()) and all(0 <= r.score <= 1 for r in odd)
    assert quality_scores(documents(spark, 0), model).count() == 0
    bare = fit_quality(docs, labels.limit(0))
    assert {r.score for r in quality_scores(docs, bare).collect()} == {0.5}


@pytest.mark.parametrize("terms", [30, 3000])
def test_block_max_search_is_exact(terms):
    rng = np.random.default_rng(2)
    vectors = []
    for _ in range(400):
        v = dict(zip(rng.choice(terms, 4, replace=False).tolist(), rng.random(4).tolist(), strict=True))
        n = sum(x * x for x in v.values()) ** 0.5
        vectors.append({t: x / n for t, x in v.items()})
    vectors += vectors[:40] + [{}]
    postings = np.array([(i, t, w) for i, v in enumerate(vectors) for t, w in v.items()])
    index = BlockMaxIndex.of(len(vectors), terms, postings[:, 0].astype(int), postings[:, 1].astype(int), postings[:, 2])
    queries = vectors[:50] + [{}]
    similarity, place = index.nearest([(np.array(list(q), np.int64), np.array(list(q.values()))) for q in queries], 15)
    for q, s, p in zip(queries, similarity, place, strict=True):
        cosine = np.array([sum(w * v.get(t, 0) for t, w in q.items()) for v in vectors])
        want = np.sort(cosine[cosine > 1e-6])[::-1][:15]
        assert np.allclose(s[: len(want)], want, atol=2e-6) and (s[len(want):] <= 1e-6).all()
        assert len(set(p[p >= 0])) == (p >= 0).sum() and np.allclose(cosine[p[p >= 0]], s[p >= 0], atol=2e-6)
        assert all(x < y for x, y, a, b in zip(p, p[1:], s, s[1:], strict=False) if a == b and y >= 0)


def test_toxicity(spark, labelled):
    docs, labels = labelled
    model = fit_toxicity(docs, labels)
    out = toxicity_scores(docs, model).join(labels, "doc_id").collect()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for r in out)
    held = [r for r in out if r.held_out]
    caught = sum(r.predicted for r in held if r.toxic)
    assert caught >= 0.7 * sum(r.toxic for r in held) and caught >= 0.9 * sum(r.predicted for r in held)
    assert all(len(r.evidence) == 15 for r in out if r.doc_id is not None and r.score != model.bare)
    assert sum(r.score == model.bare for r in out) <= 0.01 * len(out)
    odd = toxicity_scores(documents(spark), model).collect()
    assert len(odd) == len(rows()) and all(0 <= r.score <= 1 for r in odd)
    assert toxicity_scores(documents(spark, 0), model).count() == 0
    assert {r.predicted for r in toxicity_scores(docs, fit_toxicity(docs, labels.limit(0))).collect()} == {0}


def test_toxicity_against_brute_force(spark, labelled):
    """Weights, neighbours and votes by dictionaries over all terms of the labelled rows."""
    docs, labels = labelled
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    known = {r.doc_id: r.toxic for r in labels.collect() if crc32(str(r.doc_id).encode()) % 3 != 1 and r.doc_id in texts}
    words = {i: Counter(re.findall(r"[^\W\d_]+", t.lower())) for i, t in texts.items()}
    df = Counter(w for c in words.values() for w in c)
    kin = {}
    for i in known:
        split = texts[i].split()
        kin[i] = min((crc32(" ".join(split[k: k + 5]).encode()) for k in range(max(1, len(split) - 4))), default=0)
    sizes = [len({kin[i] for i, y in known.items() if y == c}) for c in (0, 1)]
    holders = [defaultdict(set), defaultdict(set)]
    for i, y in known.items():
        for w in words[i]:
            holders[y][w].add(kin[i])

    def weight(w):
        n = [len(h[w]) if w in h else 0 for h in holders]
        share, chi = sum(n) / sum(sizes), 0.0
        if sum(n) > 2 and share < 1:
            chi = (n[1] / sizes[1] - n[0] / sizes[0]) ** 2 / (share * (1 - share) * (1 / sizes[0] + 1 / sizes[1]))
        return (math.log((1 + len(texts)) / (1 + df[w])) + 1) * (0.02 + min(1, chi / 30))

    weights = {w: weight(w) for i in known for w in words[i]}

    def vector(i):
        raw = {w: (1 + math.log(n)) * weights[w] for w, n in words[i].items() if w in weights}
        norm = math.sqrt(sum(x * x for x in raw.values())) or 1
        return {w: x / norm for w, x in raw.items()}

    vectors = {i: vector(i) for i in known}
    prior = sum(known.values()) / len(known)
    got = {r.doc_id: r for r in toxicity_scores(docs, fit_toxicity(docs, labels)).collect()}
    assert len(known) < 4000 and got.keys() == texts.keys()
    for i in sorted(texts)[::25]:
        mine = vector(i)
        if not mine:
            continue
        near = sorted(((sum(x * v.get(w, 0) for w, x in mine.items()), known[k]) for k, v in vectors.items()), reverse=True)[:15]
        assert np.allclose([e.similarity for e in got[i].evidence], [s for s, _ in near], atol=3e-6)
        votes = [(s * s / (1.05 - s), y) for s, y in near]
        score = (sum(v * y for v, y in votes) + 0.5 * prior) / (sum(v for v, _ in votes) + 0.5)
        assert abs(got[i].score - score) < 1e-3


def test_mixing(spark, labelled):
    docs, labels = labelled
    targets = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}
    out = mix(docs, labels, targets).collect()
    assert len(out) == docs.count() and all(r.rate >= 0 for r in out)
    total = sum(r.n_tokens for r in out)
    share = defaultdict(float)
    for r in out:
        for k, p in r.posteriors.items():
            share[k] += r.rate * r.n_tokens * p / total
    assert all(abs(share[k] - targets[k]) < 1e-5 for k in targets)
    right = [max(r.posteriors, key=r.posteriors.get) == r.lang for r in out if r.n_tokens > 20]
    assert np.mean(right) > 0.95
    odd = mix(documents(spark), spark.createDataFrame([(k,) for k in range(30)], "doc_id long"), targets)
    assert odd.count() == len(rows()) and set(documents(spark).columns) <= set(odd.columns)
    assert mix(documents(spark).withColumn("_p", F.lit(1)).withColumn("rate", F.lit("x")), labels, targets, columns=["doc_id"]).columns == ["doc_id", "n_tokens", "rate", "posteriors", "copies"]
    assert mix(documents(spark, 0), labels, targets).count() == 0


def test_mixing_against_brute_force(spark):
    """Posteriors by plain naive Bayes over trigrams in dictionaries, rates by the same least squares in numpy."""
    rng = random.Random(2)
    texts = {k: " ".join("".join(rng.choice("abcd" if k % 3 else "xyzé") for _ in range(5)) for _ in range(rng.randint(0, 30))) for k in range(90)}
    texts |= {90: None, 91: "", 92: "ab"}
    data = [(k, t, "p" if k % 3 else "q") for k, t in texts.items()]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k,) for k in range(40)], "doc_id long")
    got = {r.doc_id: r for r in mix(docs, labels, {"p": 0.25, "q": 0.75}).collect()}

    grams = lambda t: [t[i: i + 3] for i in range(len(t) - 2)]
    bucket = lambda g: ((g[0] | g[1] << 8 | g[2] << 16) * 2654435761 % (1 << 32)) >> 19
    known = {d: [k for k in range(40) if ("p" if k % 3 else "q") == d] for d in "pq"}
    sums = {d: Counter(bucket(g) for k in ids for g in grams((texts[k] or "").encode())) for d, ids in known.items()}
    p = {}
    for k, t in texts.items():
        found = [bucket(g) for g in grams((t or "").encode())]
        logit = []
        for d in "pq":
            size = sum(sums[d].values()) + 0.5 * 8192
            evidence = sum(math.log((sums[d][g] + 0.5) / size) for g in found)
            logit.append(math.log(len(known[d]) / 40) + (evidence * min(len(found), 60) / len(found) if found else 0))
        e = np.exp(np.array(logit) - max(logit))
        p[k] = e / e.sum()
        assert np.allclose([got[k].posteriors[d] for d in "pq"], p[k], atol=1e-9)
        assert got[k].n_tokens == len((t or "").split()) and got[k].rate >= 0
    tokens = np.array([got[k].n_tokens for k in texts], float)
    rate, post = np.array([got[k].rate for k in texts]), np.array([p[k] for k in texts])
    target = np.array([0.25, 0.75]) * tokens.sum()
    assert np.abs(post.T @ (tokens * rate) - target).max() <= 1e-6 * tokens.sum()
    # the fit moves rates along the posteriors from one, as little as the targets need: rates are a cut linear function of them
    free = rate > 0
    line = np.linalg.lstsq(np.c_[post[free]], rate[free] - 1, rcond=None)[0]
    assert np.allclose(post[free] @ line, rate[free] - 1, atol=1e-6) or (~free).any()


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = spark.createDataFrame([r[:5] for r in rows()], "doc_id long, text string, lang string, source string, n_chars long")
    passage = rows()[-1][1]
    assert [len(p.STAGES), p.ORACLE_SQL] == [5, None]
    unique = spark.createDataFrame([r[:5] for r in {r[0]: r for r in rows() if r[0] is not None}.values()], docs.schema)
    classes = {r.component_id for r in queries.simhash_components(unique).collect()}
    stay = p.simhash(spark, unique, SF)
    assert stay.columns == docs.columns and stay.count() == len(classes)
    assert bag(r.doc_id for r in stay.collect()) == bag(classes)
    # null ids and repeated rows: one row of each component
    text = "some words that make a fingerprint of their own"
    odd = spark.createDataFrame([(5, text, "en", "s", 1), (None, text, "de", "s", 1), (None, "quite another text stands here alone", "en", "s", 1), (None, "quite another text stands here alone", "en", "s", 2), (5, text, "en", "s", 1)], docs.schema)
    assert bag((r.doc_id, r.text) for r in p.simhash(spark, odd, SF).collect()) == bag([(5, text), (None, "quite another text stands here alone")])
    none = spark.createDataFrame([], docs.schema)
    clash = docs.select("*", F.lit(1).alias("rate"), F.lit("x").alias("digest"), F.lit(2).alias("_row"), F.lit(3).alias("component_id"))
    for name, stage in p.STAGES:
        assert stage(spark, none, SF).count() == 0, name
        assert set(stage(spark, clash, SF).columns) >= set(docs.columns), name
    assert p.toxicity(spark, docs, SF).columns == p.decontamination(spark, docs, SF).columns == docs.columns
    assert p.line_dedup(spark, docs, SF).columns == docs.columns
    out = p.run(spark, SF)
    everything = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = out.collect()
    assert 0 < len(got) < len(everything) and len({r.doc_id for r in got}) == len(got)
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert contained_items(out, items).count() == 0 and passage


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    query, sql = queries.QUERIES[name]
    out = query(spark, SF).toPandas()
    if sql:
        con = duckdb.connect()
        for t in ("documents", "benchmark"):
            con.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
        want = con.sql(sql).df()
        assert sorted(want.columns) == sorted(out.columns)
        assert bag(out[sorted(out)].astype(str).values.tolist()) == bag(want[sorted(out)].astype(str).values.tolist())
    key = {"op1_warc": "page_id", "op11_html_extraction": "page_id", "op13_spelling_variants": "word"}.get(name, "doc_id")
    assert len(out) and key in out and not re.search("limit|sample", name) and SCHEMA
