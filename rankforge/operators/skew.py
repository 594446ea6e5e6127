"""Skew-safe equi-joins: split hot keys into salt buckets (§4.2.3).

Any key of the left side holding more than ``chunk`` rows is split into
``ceil(n / chunk)`` buckets by a hash of another column; the matching right
rows are replicated once per bucket.  Light keys keep a single bucket, so the
common case costs one extra partial aggregate over the left side.  The hot-key
table has at most rows/chunk entries, which bounds its broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.session import materialize

DEFAULT_CHUNK = 20_000


def chunk_rows(spark) -> int:
    v = spark.conf.get("rankforge.skew.chunkRows", None)
    return int(v) if v else DEFAULT_CHUNK


def hot_keys(left: DataFrame, keys: list[str], chunk: int) -> DataFrame:
    """(keys..., _s) for keys with more than ``chunk`` rows; _s = bucket count."""
    return (left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > chunk)
            .select(*keys, F.ceil(F.col("_n") / F.lit(chunk)).cast("int").alias("_s")))


def salt_sides(left: DataFrame, right: DataFrame, keys: list[str], spread: Column,
               chunk: int | None = None, counted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Add ``_salt`` to both sides so that joining on keys + _salt is exact.

    ``spread`` is a left-side column expression that varies within a key (for
    example the other id); left rows go to bucket pmod(hash(spread), _s),
    right rows are copied to every bucket of their key.  ``counted`` is a table
    with the key columns of ``left`` that is cheaper to count.  The few hot keys
    are counted once, and the count's shuffle files are deleted.
    """
    chunk = chunk or chunk_rows(left.sparkSession)
    hot = materialize(hot_keys(left if counted is None else counted, keys, chunk))
    if hot.isEmpty():      # no hot key: a plain join, nothing replicated
        return left.withColumn("_salt", F.lit(0)), right.withColumn("_salt", F.lit(0))
    hot = F.broadcast(hot)
    lt = (left.join(hot, keys, "left")
          .withColumn("_salt", F.pmod(F.xxhash64(spread), F.coalesce(F.col("_s"), F.lit(1))).cast("int"))
          .drop("_s"))
    rt = (right.join(hot, keys, "left")
          .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_s"), F.lit(1)) - 1)))
          .drop("_s"))
    return lt, rt


LOOKUP_BUCKETS = 16


def lookup(rows: DataFrame, table: DataFrame, key: str, spread: str = "user_id", how: str = "left",
           shuffled: bool = False) -> DataFrame:
    """``rows`` joined with a ``table`` of unique keys, each key's rows dealt over LOOKUP_BUCKETS buckets.

    Recommendation lists repeat the same few items for nearly every user; a
    plain join would send all rows of such an item to one task.  The table is
    copied once per bucket, which is a catalog times a constant.  The planner
    does not count the copies: with ``shuffled`` it never broadcasts them, which
    is for tables as large as the catalog.
    """
    salt = F.pmod(F.xxhash64(spread), F.lit(LOOKUP_BUCKETS)).cast("int")
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(LOOKUP_BUCKETS - 1))))
    copies = copies.hint("merge") if shuffled else copies
    return rows.withColumn("_salt", salt).join(copies, [key, "_salt"], how).drop("_salt")
