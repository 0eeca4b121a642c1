"""Operator 10: exact duplicates by skew-safe combining."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludora.llm.common import GAP, materialise, text_of

#: Salts that one digest's rows are dealt over in the first merge.
SALTS = 32


def exact_dedup(docs: DataFrame) -> DataFrame:
    """Groups of rows whose texts are equal once each whitespace run is one space.

    Returns one row per row of `docs`: doc_id, keep_id (smallest doc_id of the
    group), group_size, kept, digest (SHA-256 of the normalised text, binary).

    Texts whose digest occurs once have no equal and are not compared; the merge
    semi join that tells them apart shuffles each whole text once.  The others are combined three times, by digest and whole content each time: inside
    each task (Spark's partial aggregation), per salted digest, then the salt
    winners per digest.  A group of any size is a row per task at the first
    exchange and at most SALTS rows at the second.

    Null text counts as empty.  A null doc_id is never the one that stays unless
    the whole group has none (then keep_id is null and every row is kept).  Rows
    that repeat the kept doc_id are that document again and marked kept.  Other
    columns of `docs` are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.regexp_replace(text_of(), GAP, " ").alias("content")).withColumn("digest", F.unhex(F.sha2("content", 256)))
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt")
    narrow = materialise(rows.select("doc_id", "digest"), "digests")
    # written first: a join that reads an aggregate directly cannot have its hot keys split
    repeated = materialise(narrow.groupBy("digest", salt).count().groupBy("digest").agg(F.sum("count").alias("n")).where("n > 1").select("digest"), "repeated")
    # merge joins: one plan at every size, whose hot keys AQE can split; a broadcast would only fit small inputs
    shared = materialise(rows.join(repeated.hint("merge"), "digest", "left_semi"), "shared")
    salted = shared.groupBy("digest", salt, "content").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n"))
    winners = materialise(salted.groupBy("digest", "content").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size")), "winners")
    grouped = shared.join(winners.hint("merge"), ["digest", "content"]).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")
    single = narrow.join(repeated, "digest", "left_anti").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    return grouped.unionByName(single)
