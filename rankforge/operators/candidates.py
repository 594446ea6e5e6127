"""First n unseen items of a globally ranked list, for every user (§4.2.4).

A user who has seen s items needs only the first n + s positions of the list,
so each user expands to ``sequence(1, n + s)`` — linear in users and history,
never users x items.  Positions up to ``HEAD_ROWS``, which nearly every user
asks for, join a broadcast of the list head: that many short rows at most, by
the filter and whatever the data.  The positions past it take a shuffled
equi-join, whose key multiplicity is the number of users with such a history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HEAD_ROWS = 10_000      # rows of a ranked list that are broadcast


def first_unseen(users_s: DataFrame, ranked: DataFrame, seen: DataFrame | None, n: int,
                 head_rows: int | None = None, keys: list[str] | None = None) -> DataFrame:
    """users_s(user_id, [keys], s) x ranked([keys], item_id, score, rank) -> (user_id, [keys], item_id, score, rank).

    ``s`` is the number of items the user has seen (in that key's list; 0 when
    ``seen`` is None).  With ``keys`` (e.g. category) each key has its own
    ranked list and the head bound applies per key.  Output rank is the
    position among the user's unseen items of that list, 1..n.
    """
    keys = keys or []
    L = HEAD_ROWS if head_rows is None else head_rows
    span = F.lit(n) + (F.coalesce(F.col("s"), F.lit(0)) if seen is not None else F.lit(0))
    cand = users_s.select("user_id", *keys, F.explode(F.sequence(F.lit(1), span.cast("int"))).alias("pos"))
    r = ranked.select(*keys, "item_id", "score", F.col("rank").alias("pos"))
    on = [*keys, "pos"]
    light = cand.where(F.col("pos") <= L).join(F.broadcast(r.where(F.col("pos") <= L)), on)
    heavy = cand.where(F.col("pos") > L).join(r.where(F.col("pos") > L), on)
    c = light.unionByName(heavy)
    if seen is not None:
        c = c.join(seen.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    w = Window.partitionBy("user_id", *keys).orderBy("pos")
    return (c.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
            .select("user_id", *keys, "item_id", "score", "rank"))
