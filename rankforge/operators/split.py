"""Train / test splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankforge.operators.matrix import with_totals
from rankforge.operators.ranking import global_rank
from rankforge.session import materialize

_FIRST = ["ts", "user_id", "item_id", "interaction_type", "duration_seconds", "rating"]


def _order(df: DataFrame) -> list[str]:
    """Q7: a total order over every column, so the cut is deterministic; rows equal in all are interchangeable."""
    return [c for c in _FIRST if c in df.columns] + sorted(c for c in df.columns if c not in _FIRST)


def _compared(order: list[str]) -> tuple[Column, Column]:
    """(row before the boundary, row equal to it); the boundary's columns are ``_b_<name>``, nulls come last."""
    before, same = F.lit(False), F.lit(True)
    for c in order:
        own, bound = F.col(c), F.col(f"_b_{c}")
        before = before | same & F.coalesce(F.when(bound.isNull(), own.isNotNull()).otherwise(own < bound), F.lit(False))
        same = same & own.eqNullSafe(bound)
    return before, same


def _boundary(interactions: DataFrame, cut: int) -> tuple[DataFrame, int, int] | None:
    """The row at position ``cut`` as a one-row table, and how many rows equal to it there are up to there and in all.

    Counts per day (at most one per date) give the day of the cut; only that day's rows are ranked.
    """
    order = _order(interactions)
    by_time = order[0] == "ts"
    day = F.to_date("ts") if by_time else F.lit(None).cast("date")
    counts = {r.day: r.n for r in interactions.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n")).collect()}
    passed = 0
    for d in sorted(counts, key=lambda d: (d is None, d)):
        if passed + counts[d] >= cut:
            break
        passed += counts[d]
    own = interactions.where(day.eqNullSafe(F.lit(d).cast("date")))
    ranked = global_rank(own, [F.col(c).asc_nulls_last() for c in order], "_pos", kind="long")
    row = materialize(ranked.where(F.col("_pos") == cut - passed).select(*[F.col(c).alias(f"_b_{c}") for c in order]))
    _, same = _compared(order)
    n = with_totals(ranked, row).where(same).agg(F.sum(F.when(F.col("_pos") <= cut - passed, 1).otherwise(0)), F.count(F.lit(1))).first()
    return row, int(n[0]), int(n[1])


def labelled_chronological(interactions: DataFrame, test_ratio: float = 0.2) -> DataFrame:
    """W3 as one table with a ``split`` column: the first int(n * (1 - ratio)) rows in time order 'train', the rest 'test'.

    The cut is found as a quantile (counts per day, a rank inside one day) and every row is compared with the row at
    the cut, so the table itself is neither sorted nor shuffled.  Rows equal to it in all columns, which comparing
    cannot tell apart, are dealt by their number.
    """
    n = interactions.count()
    cut = int(n * (1.0 - float(test_ratio)))
    if cut <= 0 or cut >= n:
        return interactions.withColumn("split", F.lit("train" if cut > 0 else "test"))
    row, up_to, equal = _boundary(interactions, cut)
    order = _order(interactions)
    before, same = _compared(order)
    rest = with_totals(interactions, row).where(~same).select(*interactions.columns, F.when(before, "train").otherwise("test").alias("split"))
    copies = F.explode(F.sequence(F.lit(1), F.lit(equal))).alias("_k")
    dealt = row.select(*[F.col(f"_b_{c}").alias(c) for c in order], copies)
    return rest.unionByName(dealt.select(*interactions.columns, F.when(F.col("_k") <= up_to, "train").otherwise("test").alias("split")))


def chronological_split(interactions: DataFrame, test_ratio: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """(train, test).  Both sides feed every model fit, so the labelled table is written once."""
    labelled = materialize(labelled_chronological(interactions, test_ratio))
    return tuple(labelled.where(F.col("split") == side).drop("split") for side in ("train", "test"))


def random_split(interactions: DataFrame, test_ratio: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """A row is train when the MD5 of the seed and its columns as text, as a fraction, falls under 1 - ratio.

    Unlike ``randomSplit`` the outcome does not depend on partitioning, so it repeats on any cluster, and any engine
    with MD5 gives the same rows; identical rows land on the same side.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in interactions.columns])
    u = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    t = interactions.withColumn("_u", u)
    return (t.where(F.col("_u") < 1.0 - test_ratio).drop("_u"), t.where(F.col("_u") >= 1.0 - test_ratio).drop("_u"))
