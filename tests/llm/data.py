"""Small documents with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, key long, line string, rid long"


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(n))


def rows(seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    passage, line = words(rng, 60), words(rng, 14)
    texts = [words(rng, rng.randint(0, 90)) for _ in range(40)]
    texts += [f"{words(rng, 9)}\n{passage}  {words(rng, 7)}\n{line}" for _ in range(25)]
    texts += [texts[41]] * 3 + [texts[42].replace(" ", "\t"), texts[43].upper(), texts[44].replace(line, line + " zz")]
    texts += [None, "", " \n\t ", "a", "a b", "a b c", "ab " * 3000, "x" * 5000, "é" * 60 + " ünï " * 30, words(rng, 4000) + " " + passage, passage]
    out = [(k, t) for k, t in enumerate(texts)]
    rng.shuffle(out)
    out += [(None, passage), (None, None), (41, texts[41]), (41, texts[41]), (3, passage)]
    return [(i, t, "en" if (i or 0) % 3 else None, None, None, "clash", 7, "clash", 1) for i, t in out]


def documents(spark, n: int | None = None):
    return spark.createDataFrame(rows()[:n] if n is not None else rows(), SCHEMA)
