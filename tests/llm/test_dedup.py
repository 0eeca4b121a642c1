"""Operators 2, 4, 5, 7 and 10 against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from ludora.llm import lines
from ludora.llm.common import NO_ID
from ludora.llm.components import components
from ludora.llm.exact import exact_dedup
from ludora.llm.lines import dedup_lines
from ludora.llm.simhash import BKTree, fingerprint, fingerprint_links, simhash_components
from ludora.llm.substring import substring_dedup
from ludora.llm.suffix import suffix_dedup

from .data import SCHEMA, documents, rows, words


def ident(doc_id):
    return NO_ID if doc_id is None else doc_id


def bag(values):
    return sorted(values, key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


def test_substring(docs):
    data = [(ident(r[0]), r[0], (r[1] or "").encode().split()) for r in rows()]
    first: dict = {}
    for i, _, w in data:
        for k in range(len(w) - 12):
            first[tuple(w[k: k + 13])] = min(i, first.get(tuple(w[k: k + 13]), i))
    want = []
    for i, raw, w in data:
        gone = {j for k in range(len(w) - 12) if first[tuple(w[k: k + 13])] < i for j in range(k, k + 13)}
        want.append((raw, len(w), len(gone), " ".join(x.decode() for j, x in enumerate(w) if j not in gone)))
    assert bag(tuple(r) for r in substring_dedup(docs).collect()) == bag(want)


def test_suffix(docs):
    data = [(ident(r[0]), r[0], (r[1] or "").encode()) for r in rows()]
    first: dict = {}
    for i, _, t in data:
        for k in range(len(t) - 49):
            first[t[k: k + 50]] = min(i, first.get(t[k: k + 50], i))
    want = []
    for i, raw, t in data:
        keep = bytearray(b"\1" * len(t))
        for k in range(len(t) - 49):
            if first[t[k: k + 50]] < i:
                keep[k: k + 50] = bytes(50)
        want.append((raw, len(t), keep.count(0), len(re.findall(b"\0+", bytes(keep))), bytes(x for x, y in zip(t, keep, strict=True) if y)))
    got = [(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in suffix_dedup(docs).collect()]
    assert bag(got) == bag(want)


def test_long_documents_are_cut_into_pieces(spark):
    text = " ".join(f"w{k * 7919 % 100003}" for k in range(60_000))
    docs = spark.createDataFrame([(1, text), (2, "head " + text + " tail"), (3, "z" * 600_000)], "doc_id long, text string")
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept[:9]) for r in substring_dedup(docs).collect()}[2] == (60_002, 60_000, "head tail")
    got = {r.doc_id: (r.n_removed, len(r.spans), bytes(r.kept)) for r in suffix_dedup(docs).collect()}
    assert got[2] == (len(text), 1, b"head  tail") and got[3][:2] == (0, 0)


@pytest.mark.parametrize("operator", [substring_dedup, suffix_dedup])
def test_many_texts_of_one_id(spark, operator):
    """Rows without an id, or of one id, are told apart by their texts: two of them share 16 bits of a hash."""
    rng = random.Random(8)
    texts = [words(rng, 30) for _ in range(900)]
    passage = words(rng, 30)
    data = [(1, passage)] + [(None, f"{passage} {t}" if k % 2 else t) for k, t in enumerate(texts)] + [(7, t) for t in (words(rng, 30) for _ in range(900))]
    got = operator(spark.createDataFrame(data, "doc_id long, text string")).collect()
    kept = [bytes(r.kept).decode() if operator is suffix_dedup else r.kept for r in got]
    assert sorted(x.strip() for x in kept) == sorted([passage, *texts, *(t for i, t in data if i == 7)])


def test_exact(docs):
    data = [(r[0], re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")) for r in rows()]
    groups = defaultdict(list)
    for i, t in data:
        groups[t].append(i)
    want = []
    for i, t in data:
        keep = min((x for x in groups[t] if x is not None), default=None)
        want.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in exact_dedup(docs).collect()]
    assert bag(got) == bag(want)


def brute_fingerprint(text: str) -> int:
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text).encode().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[k: k + 3]), 42) for k in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs):
    data = [(r[0], brute_fingerprint(r[1] or "")) for r in rows()]
    assert all(fingerprint((r[1] or "").encode()) == f for r, (_, f) in zip(rows(), data, strict=True))
    fps = sorted({f for _, f in data})
    comp = {f: f for f in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if (a ^ b).bit_count() <= 2 and comp[a] != comp[b]:
                    comp[a] = comp[b] = min(comp[a], comp[b])
                    changed = True
    least: dict = {}
    for i, f in data:
        if i is not None:
            least[comp[f]] = min(i, least.get(comp[f], i))
    want = [(i, f"{f:016x}", least.get(comp[f])) for i, f in data]
    assert bag(tuple(r) for r in simhash_components(docs).collect()) == bag(want)


def test_bk_tree_and_split_shards(spark, monkeypatch):
    import random

    import ludora.llm.simhash as module

    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(20)]
    values = sorted({v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for v in base for _ in range(20)} | set(base))
    tree = BKTree()
    for v in values:
        tree.add(v)
    for v in values[:40]:
        assert {tree.values[k] for k in tree.near(v, 2)} == {x for x in values if (x ^ v).bit_count() <= 2}
    signed = [(k, v - (1 << 64) if v >> 63 else v) for k, v in enumerate(values)]
    points = spark.createDataFrame(signed, "node long, fp long")
    monkeypatch.setattr(module, "TREE_NODES", 3)  # every larger shard is cut into several trees
    got = {r.node: r.root for r in components(fingerprint_links(points, 2)).collect()}
    root = list(range(len(values)))
    for _ in range(8):
        for a in range(len(values)):
            for b in range(len(values)):
                if (values[a] ^ values[b]).bit_count() <= 2:
                    root[a] = root[b] = min(root[a], root[b])
    assert all(got.get(k, k) == root[k] for k in range(len(values)))


def test_components_of_a_path_and_a_hub(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(41)) and all(got[k] == 100 for k in range(100, 160)) and len(got) == 101


def brute_lines(data, threshold=0.8):
    sets = {}
    places = []
    for i, t in data:
        for n, line in enumerate(t.split("\n")):
            if line.strip(" "):
                sets[line] = frozenset(overlapping(line))
                places.append(((i, n), line))
    known = sorted(sets)
    comp = {x: k for k, x in enumerate(known)}
    for a in known:
        for b in known:
            if a < b and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) and comp[a] != comp[b]:
                old, new = comp[b], comp[a]
                comp = {x: new if c == old else c for x, c in comp.items()}
    stay = {}
    for p, line in places:
        stay[comp[line]] = min(p, stay.get(comp[line], p))
    return {p for p, line in places if stay[comp[line]] != p}


def test_lines(spark):
    unique = {r[0]: r for r in rows() if r[0] is not None}.values()  # ids are unique here; repeats below
    docs = spark.createDataFrame(list(unique), SCHEMA)
    data = [(r[0], r[1] or "") for r in unique]
    gone = brute_lines(data)
    assert len(gone) > 20
    got = dedup_lines(docs)
    assert set(docs.columns) <= set(got.columns)
    got = {r.doc_id: r.text.split("\n") for r in got.collect()}
    lost = 0
    for i, t in data:  # banding may miss links between lines at the threshold; it never invents any
        must = Counter(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone)
        assert not must - Counter(got[i])
        lost += sum((Counter(got[i]) - must).values())
    assert lost <= 0.1 * len(gone)  # most near lines of this fixture stand at the threshold


def test_lines_of_one_hot_band(spark, monkeypatch):
    """All lines share one band: links between lines that are not among its ends are found too."""
    rng = random.Random(11)
    bases = [words(rng, 80).split() for _ in range(40)]
    data = []
    for i in range(240):
        w = list(rng.choice(bases))
        w[rng.randrange(len(w))] = words(rng, 1)
        data.append((i, " ".join(w)))
    gone = brute_lines(data)
    assert len(gone) > 150
    monkeypatch.setattr(lines, "_bands", lambda firsts, n: F.array(F.lit(1).cast("long")))
    got = {r.doc_id for r in dedup_lines(spark.createDataFrame(data, "doc_id long, text string")).where("n_removed > 0").collect()}
    assert got == {i for i, _ in gone}


def test_lines_that_share_a_band_by_chance_do_not_meet_as_text(spark, monkeypatch):
    """One band, few different shingles: only pairs whose sketches allow it are compared as texts, and none that is near is lost, also by prefixes."""
    rng = random.Random(29)
    data = []
    for i in range(150):
        low = "".join(rng.choices("abc", k=rng.randint(60, 90)))
        data += [(2 * i, low), (2 * i + 1, low[:40] + "z" + low[41:] if i % 2 else low + "abc")]
    gone = {i for i, _ in brute_lines(data)}
    assert len(gone) > 100
    monkeypatch.setattr(lines, "_bands", lambda firsts, n: F.array(F.lit(1).cast("long")))
    near, compared = lines._near, []

    def counted(pairs, texts, threshold):
        compared.append(pairs.count())
        return near(pairs, texts, threshold)

    monkeypatch.setattr(lines, "_near", counted)
    for most in (10_000, 1):
        monkeypatch.setattr(lines, "MOST_COMPARED", most, raising=False)
        compared.clear()
        got = {r.doc_id for r in dedup_lines(spark.createDataFrame(data, "doc_id long, text string")).where("n_removed > 0").collect()}
        assert got == gone
        assert sum(compared) < 2 * len(data)


def overlapping(line):
    """The usual shingles, whatever the operator's are: five characters from each place."""
    low = line.lower()
    return {low[k: k + 5] for k in range(max(1, len(low) - 4))}


def test_lines_by_overlapping_shingles(spark):
    """Every character counts: one changed word of a line leaves it near, another end of a URL, CJK or tab line need not."""
    rng = random.Random(23)
    data = []
    for _ in range(60):
        w = words(rng, 26).split()
        data += [" ".join(w), " ".join([*w[:12], words(rng, 1), *w[13:]])]
    chars = [chr(0x4E00 + k) for k in range(3000)] + [chr(0x1F600 + k) for k in range(40)]
    for _ in range(20):
        head = "".join(rng.choices(chars, k=16))
        data += [head + "".join(rng.choices(chars, k=40)) for _ in range(2)]
        long = "".join(rng.choices(chars, k=90))
        data += [long, long[:50] + "\u7532" + long[51:]]
        data += ["https://www.example.com/" + "/".join(words(rng, 3).split()) for _ in range(2)]
        data += ["row-prefix-of-16\t" + words(rng, 9).replace(" ", "\t") for _ in range(2)]
    data += ["https://www.example.com/a", "https://www.example.com/b" + "/b" * 9, "ab " * 7 + "a", "ab " * 3000, "x", "X", "xy"]
    sets = [overlapping(x) for x in data]
    root = list(range(len(data)))
    for a in range(len(data)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) and root[a] != root[b]:
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = [new if x == old else x for x in root]
    want = {i for i, x in enumerate(root) if x != i}
    assert 60 < len(want) < 100
    got = {r.doc_id for r in dedup_lines(spark.createDataFrame(list(enumerate(data)), "doc_id long, text string")).where("n_removed > 0").collect()}
    assert got == want


def test_lines_repeated_rows_and_null_ids(spark):
    data = [(1, "one two three four five six\nrest of one"), (1, "one two three four five six\nrest of one"), (None, "one two three four five six\n\n"), (2, None)]
    got = Counter((r.doc_id, r.text, r.n_removed) for r in dedup_lines(spark.createDataFrame(data, "doc_id long, text string")).collect())
    assert got == Counter({(1, "one two three four five six\nrest of one", 0): 2, (None, "\n", 1): 1, (2, "", 0): 1})


@pytest.mark.parametrize("operator", [substring_dedup, suffix_dedup, exact_dedup, simhash_components, dedup_lines])
def test_empty_table(spark, operator):
    assert operator(documents(spark, 0)).count() == 0


def test_native_line_dedup_has_no_python(docs):
    plan = dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_sketches_are_exploded_by_compiled_code(spark):
    rng = random.Random(11)
    texts = [words(rng, n) for n in (1, 3, 40, 300)] + ["a", "aaaaaaaaaaaa", "Ünï ß" * 7]
    df = spark.createDataFrame(list(enumerate(texts)), "rid long, line string")
    sketches = lines._sketches(df)
    plan = sketches._jdf.queryExecution().executedPlan().toString()
    generators = [x for x in plan.splitlines() if "Generate " in x]
    assert generators and not any("lambda" in x for x in generators), plan
    found = {r["rid"]: r["sketch"] for r in sketches.collect()}
    for rid, text in enumerate(texts):
        chars = text.lower().encode("utf-32-be")
        places = range(0, max(len(chars) - 4 * lines.SHINGLE, 0) + 1, 4)
        want = [0] * lines.SKETCH_WORDS
        for h in {xxhash.xxh64_intdigest(chars[i: i + 4 * lines.SHINGLE], seed=42) for i in places}:
            want[h >> 6 & lines.SKETCH_WORDS - 1] ^= 1 << (h & 63)
        assert [x % (1 << 64) for x in found[rid]] == want
