"""The SVD of a matrix whose column side is wider than a broadcast."""
import numpy as np
from pyspark.sql import functions as F

from rankforge.operators import blocks, factorize


def test_wide_products_in_passes(spark, monkeypatch):
    """A column side that is too wide for one broadcast is multiplied a few columns at a time, with the same result and no block join."""
    rnd = np.random.default_rng(4)
    dense = rnd.standard_normal((60, 40)) * (rnd.random((60, 40)) < 0.4)
    r, c = np.nonzero(dense)
    entries = spark.createDataFrame([(int(a), int(b) + 100, float(dense[a, b])) for a, b in zip(r, c)], "row long, col long, val double")
    monkeypatch.setattr(blocks, "BLOCK_IDS", 8)
    monkeypatch.setattr(blocks, "BROADCAST_BYTES", 5 * 8 * 8 * 4 + 1)            # four columns of five blocks
    monkeypatch.setattr(factorize, "product", None)
    assert blocks.columns_at_a_time(5, 11) == 4 and blocks.columns_at_a_time(5, 3) == 3 and blocks.columns_at_a_time(50, 11) == 0
    u, v, sigma, residual = factorize.truncated_svd(entries, 3, 8, 1, 1e-7)
    want = np.linalg.svd(dense, compute_uv=False)[:3]
    assert np.allclose(sigma, want, rtol=1e-8) and residual.max() <= 1e-7
    left, right = ({x.id: np.array(x.vec) for x in f.collect()} for f in (u, v))
    assert np.allclose(sum(np.outer(left[a], right[b + 100]) * dense[a, b] for a, b in zip(r, c)).diagonal(), want)


def test_sides_are_not_broadcast(spark):
    """The tables of ids, which are copied for the lookup, are joined by a sort whatever the planner takes their size for."""
    seen = []
    real = blocks.materialize
    blocks.materialize = lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or real(df)
    try:
        ids = spark.range(20).select("id", F.lit(0).alias("b"), F.col("id").cast("int").alias("p"))
        at = blocks.placed(spark.createDataFrame([(1, 2, 3.0), (4, 2, 1.0)], "row long, col long, val double"), ids, ids)
    finally:
        blocks.materialize = real
    assert "Broadcast" not in seen[0] and seen[0].count("SortMergeJoin") == 2
    assert sorted((r.rp, r.cp, r.val) for r in at.collect()) == [(1, 2, 3.0), (4, 2, 1.0)]
