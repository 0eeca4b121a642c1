"""Candidate generation (JN-7, JN-8, WN-8, ST-4).

The candidate set of a user is the item universe minus the items the user
has seen, optionally capped to the first N items in string order of
`app_id`.  Instead of a cross join, items carry a dense string-order rank.
With a cap a user's ranks are listed from its sorted seen ranks, N rows and
nothing else, and meet the few items below the largest rank in a
broadcast join.  With no cap rank bins cover the whole
catalogue: scoring every unseen item is then what the operator means.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .split import dense_index

BIN_SIZE = 512
BROADCAST_MAX_ITEMS = 2_000_000


def rank_items(items: DataFrame, key: str = "app_id") -> DataFrame:
    """Items with `item_rank`: 0-based rank in string order of the key."""
    keyed = items.select(key).distinct().withColumn("_s", F.col(key).cast("string"))
    idx = dense_index(keyed, "_s", index_col="item_rank")
    return keyed.join(idx, "_s").select(key, "item_rank")


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint only after a row-count check; else leave it to AQE."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def candidate_pool(users: DataFrame, ranked_items: DataFrame, seen: DataFrame,
                   cap: int | None = None, user: str = "author_id",
                   key: str = "app_id") -> DataFrame:
    """(user, app_id, item_rank): unseen items, first `cap` by rank per user."""
    if cap is not None:
        return _capped_pool(users, ranked_items, seen, cap, user, key)
    n_items = ranked_items.select(F.count(F.lit(1))).scalar()
    seen_in = seen.select(user, key).distinct().join(ranked_items.select(key), key, "left_semi")
    u = users.select(user).distinct()
    u = u.select(user, F.explode(F.sequence(F.lit(0), F.floor((n_items - 1) / BIN_SIZE))).alias("_bin"))
    items = ranked_items.withColumn("_bin", F.floor(F.col("item_rank") / BIN_SIZE))
    items = bounded_broadcast(items, BROADCAST_MAX_ITEMS)
    return (u.join(items, "_bin").select(user, key, "item_rank")
            .join(seen_in, [user, key], "left_anti"))


def _capped_pool(users: DataFrame, ranked_items: DataFrame, seen: DataFrame, cap: int, user: str, key: str) -> DataFrame:
    """The first `cap` unseen items of each user; no row of the pool is shuffled or sorted.

    The j-th (from 0) seen rank s of a user has s - j unseen ones before it, so the pool ends
    at the rank `cap` + the number of seen ranks with s - j < cap.
    Ranks below that end and not seen are listed where the user's row is.
    """
    n_items = ranked_items.count()
    ranks = (seen.select(user, key).join(ranked_items.select(key, "item_rank"), key)
             .groupBy(user).agg(F.sort_array(F.collect_set("item_rank")).alias("_seen")))
    before = F.size(F.filter("_seen", lambda s, j: s - j < cap))
    u = written(users.select(user).distinct().join(ranks, user, "left")
                .withColumn("_seen", F.coalesce("_seen", F.array().cast("array<bigint>")))
                .withColumn("_limit", F.least(F.lit(n_items), F.lit(cap) + before)).where("_limit > 0"), "pool-users")
    last = u.agg(F.max("_limit")).first()[0] or 0
    items = bounded_broadcast(ranked_items.where(F.col("item_rank") < last), BROADCAST_MAX_ITEMS)
    below = F.sequence(F.lit(0).cast("bigint"), F.col("_limit").cast("bigint") - 1)
    return (u.select(user, F.explode(F.array_except(below, "_seen")).alias("item_rank"))
            .join(items, "item_rank").select(user, key, "item_rank"))
