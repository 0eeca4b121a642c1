"""Text column functions (FN-1 .. FN-6, FN-11).  No Python UDF anywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word pattern: runs of two or more Unicode letters, digits or underscores.
# Equal to the `\b\w{2,}\b` token rule on str input, and has the same
# meaning in Java regex (Spark) and RE2 (the DuckDB oracle).
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """FN-1: null -> '', lower-case, keep only [a-z0-9 ]."""
    return F.regexp_replace(F.lower(F.coalesce(_c(c), F.lit(""))), r"[^a-z0-9 ]", "")


def clean_text_compact(c) -> Column:
    """FN-2: as FN-1 but spaces removed too (whole text becomes one token)."""
    return F.regexp_replace(F.lower(F.coalesce(_c(c), F.lit(""))), r"[^a-z0-9]", "")


def whitespace_tokens(c) -> Column:
    """FN-3: split on whitespace runs; an empty or blank text has no tokens."""
    return F.filter(F.split(F.trim(F.coalesce(_c(c), F.lit(""))), r"\s+"), lambda t: t != "")


def word_tokens(c, lowercase: bool = True) -> Column:
    """FN-4: lower-cased word tokens of length >= 2 (Unicode aware)."""
    x = F.coalesce(_c(c), F.lit(""))
    if lowercase:
        x = F.lower(x)
    return F.regexp_extract_all(x, F.lit(WORD_PATTERN), 0)


def with_bigrams(tokens: Column) -> Column:
    """FN-5: unigrams followed by adjacent-pair bigrams joined by a space."""
    bigrams = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0))),
        lambda i: F.concat(F.element_at(tokens, i), F.lit(" "), F.element_at(tokens, i + 1)),
    )
    bigrams = F.when(F.size(tokens) >= 2, bigrams).otherwise(F.array().cast("array<string>"))
    return F.concat(tokens, bigrams)


def drop_stop_words(tokens: Column, stop_words) -> Column:
    sw = F.array(*[F.lit(w) for w in sorted(stop_words)])
    return F.filter(tokens, lambda t: ~F.array_contains(sw, t))


def char_length(c) -> Column:
    """FN-6: length in code points."""
    return F.char_length(_c(c))


def joined_sorted(values: Column, sep: str = ", ") -> Column:
    """FN-11: ordered concatenation of a collected list."""
    return F.concat_ws(sep, F.array_sort(values))
