"""Registered queries of the numbered operators: the thin digest views and their DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludora.llm.decontam import contained_items
from ludora.llm.exact import exact_dedup
from ludora.llm.html_text import main_text
from ludora.llm.lines import dedup_lines
from ludora.llm.mixing import mix
from ludora.llm.quality import fit_quality, quality_scores
from ludora.llm.ranking import ranked_search
from ludora.llm.simhash import simhash_components
from ludora.llm.substring import substring_dedup
from ludora.llm.suffix import suffix_dedup
from ludora.llm.toxicity import fit_toxicity, toxicity_scores
from ludora.llm.variants import spelling_variants
from ludora.llm.warc import read_warc, write_warc
from ludora.session import checkpoint_dir
from ludora.sources.tables import table

#: The check's pages make several shards and files of this size; the operator's defaults are larger.
SHARD_BYTES, FILE_BYTES = 16 << 20, 4 << 20
#: Token shares that the mix is driven to.
TARGETS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark).rstrip('/')}/ludora-llm/{uuid.uuid4().hex}-warc"
    write_warc(table(spark, sf_dir, "pages"), path, "page_id", "url", "html", SHARD_BYTES, FILE_BYTES)
    return read_warc(spark, path).select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), TARGETS, columns=["doc_id"])
    return out.select("doc_id", "n_tokens", "posteriors", "rate", "copies")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity_scores(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"

OP2_SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
x AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM s),
f AS (SELECT k, min(doc_id) AS first_id FROM x GROUP BY k),
r AS (SELECT x.doc_id, list(i) AS starts FROM x JOIN f USING (k) WHERE f.first_id < x.doc_id GROUP BY x.doc_id),
c AS (SELECT doc_id, list_distinct(flatten(list_transform(starts, lambda p: range(p, p + 13)))) AS gone FROM r),
p AS (SELECT d.doc_id, d.w, coalesce(c.gone, []) AS gone FROM d LEFT JOIN c ON d.doc_id = c.doc_id),
k AS (SELECT doc_id, w, gone, list_filter(range(1, len(w) + 1), lambda j: NOT list_contains(gone, j)) AS kept FROM p)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed,
 sha256(coalesce(array_to_string(list_transform(kept, lambda j: w[j]), ' '), '')) AS kept_sha256 FROM k
"""

OP6_SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS.format('translate(text, $$ABCDEFGHIJKLMNOPQRSTUVWXYZ$$, $$abcdefghijklmnopqrstuvwxyz$$)')} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format('translate(text, $$ABCDEFGHIJKLMNOPQRSTUVWXYZ$$, $$abcdefghijklmnopqrstuvwxyz$$)')} AS w FROM benchmark),
i AS (SELECT item_id, least(5, len(w)) AS n, unnest(list_distinct(list_transform(range(1, len(w) - least(5, len(w)) + 2), lambda j: array_to_string(w[j:j + least(5, len(w)) - 1], ' ')))) AS s FROM b WHERE len(w) > 0),
z AS (SELECT DISTINCT n FROM i),
x AS (SELECT doc_id, n, unnest(list_distinct(list_transform(range(1, len(w) - n + 2), lambda j: array_to_string(w[j:j + n - 1], ' ')))) AS s FROM d, z WHERE len(w) >= n),
t AS (SELECT item_id, count(*) AS n_shingles FROM i GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS n_found FROM x JOIN i USING (n, s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shingles, n_found, n_found / n_shingles AS containment
FROM m JOIN t USING (item_id) WHERE n_found >= 0.8 * n_shingles
"""

OP10_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
 doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256 FROM d WINDOW g AS (PARTITION BY t)
"""

_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all(coalesce({_LOWERED.format('text')}, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP12_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
b AS (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark),
q AS (SELECT item_id, t, count(*) AS repeats FROM b GROUP BY item_id, t),
a AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS length FROM d WHERE len(w) > 0),
p AS (SELECT r, doc_id, len(w) AS n, unnest(w) AS t FROM d),
f AS (SELECT r, doc_id, n, t, count(*) AS tf FROM p GROUP BY r, doc_id, n, t),
i AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM f, a WHERE t IN (SELECT t FROM q) GROUP BY t, docs),
s AS (SELECT q.item_id, f.r, f.doc_id,
 CAST(sum(q.repeats * i.weight * ((1000000000 * f.tf) // (1000 * f.tf + 12 * (100 - 25 + ((25 * f.n * a.docs) // a.length))))) AS BIGINT) AS score
 FROM q JOIN i USING (t) JOIN f USING (t), a GROUP BY q.item_id, f.r, f.doc_id),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place, doc_id, score FROM s WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM k WHERE place <= 20
"""

OP13_SQL = rf"""
WITH RECURSIVE z AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS tab),
r AS (SELECT doc_id, unnest(regexp_extract_all({_LOWERED.format('text')}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
g AS (SELECT doc_id, run, count(*) AS n FROM r GROUP BY doc_id, run),
c AS (SELECT run, n, list_transform(string_split(concat(doc_id, ':', run), ''), lambda x: CAST(ord(x) AS BIGINT)) AS cps FROM g),
h AS (SELECT run, n, xor(4294967295, list_reduce(flatten(list_transform(cps, lambda x: CASE WHEN x < 128 THEN [x] ELSE [192 + (x >> 6), 128 + (x & 63)] END)),
 lambda crc, x: xor(crc >> 8, tab[1 + (xor(crc, x) & 255)]), CAST(4294967295 AS BIGINT))) AS h FROM c, z),
e AS (SELECT CASE WHEN h % 97 = 0 THEN concat(left(run, CAST(h % length(run) AS BIGINT)), substr(run, CAST(h % length(run) AS BIGINT) + 2)) ELSE run END AS word, n FROM h),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM e WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
x AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
y AS (SELECT word, n, concat(left(word, i - 1), '*', substr(word, i + 1)) AS cut, concat(left(word, i - 1), substr(word, i + 1)) AS less FROM x),
l AS (SELECT DISTINCT y.word AS a, w.word AS b FROM y JOIN w ON y.less = w.word),
m AS (SELECT a.word, b.word AS near FROM y a JOIN y b ON a.cut = b.cut AND a.word <> b.word UNION SELECT a, b FROM l UNION SELECT b, a FROM l),
o AS (SELECT m.word, m.near, w.n AS near_n, count(*) OVER (PARTITION BY m.word) AS n_near,
 row_number() OVER (PARTITION BY m.word ORDER BY w.n DESC, encode(m.near)) AS place FROM m JOIN w ON w.word = m.near),
f AS (SELECT w.word, w.n, coalesce(o.n_near, 0) AS n_near, CASE WHEN o.near_n >= 2 * w.n THEN o.near END AS form, CASE WHEN o.near_n >= 2 * w.n THEN o.near_n END AS form_n
 FROM w LEFT JOIN o ON o.word = w.word AND o.place = 1),
t(word, root, depth) AS (SELECT word, word, 0 FROM f UNION ALL SELECT t.word, f.form, t.depth + 1 FROM t JOIN f ON f.word = t.root WHERE f.form IS NOT NULL),
u AS (SELECT word, arg_max(root, depth) AS root FROM t GROUP BY word)
SELECT f.word, f.form, u.root, f.n, f.n_near, f.form_n FROM f JOIN u USING (word)
"""

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_warc": (op1_warc, None),
    "op2_substring_dedup": (op2_substring_dedup, OP2_SQL),
    "op3_quality": (op3_quality, None),
    "op4_simhash": (op4_simhash, None),
    "op5_suffix_dedup": (op5_suffix_dedup, None),
    "op6_decontamination": (op6_decontamination, OP6_SQL),
    "op7_line_dedup": (op7_line_dedup, None),
    "op8_mixing": (op8_mixing, None),
    "op9_toxicity": (op9_toxicity, None),
    "op10_exact_dedup": (op10_exact_dedup, OP10_SQL),
    "op11_html_extraction": (op11_html_extraction, None),
    "op12_ranked_search": (op12_ranked_search, OP12_SQL),
    "op13_spelling_variants": (op13_spelling_variants, OP13_SQL),
}
