"""Scalar column expressions (P1-P4, P9-P15).  All JVM-side, codegen friendly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference: implicit weight per interaction
# type; any other type weighs 1.0.
TYPE_WEIGHTS = {"view": 1.0, "click": 2.0, "like": 4.0, "purchase": 5.0}
DEFAULT_WEIGHT = 1.0

MICROS_PER_DAY = 86_400_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def event_weight(col="interaction_type", default: float | None = DEFAULT_WEIGHT) -> Column:
    """View 1, click 2, like 4, purchase 5, other ``default`` (NULL keeps NULL)."""
    c = _c(col)
    expr = None
    for name, w in TYPE_WEIGHTS.items():
        expr = (F.when(c == name, F.lit(w)) if expr is None else expr.when(c == name, F.lit(w)))
    return expr.otherwise(F.lit(default).cast("double") if default is not None else F.lit(None).cast("double"))


def implicit_score(type_col="interaction_type", duration_col="duration_seconds",
                   rating_col="rating") -> Column:
    """Weight x engagement boost x rating factor; rating 0 or NULL counts as none."""
    dur = _c(duration_col)
    rating = _c(rating_col)
    boost = F.when(dur.isNotNull() & (dur > 60),
                   F.least(F.lit(1.5), F.lit(1.0) + dur.cast("double") / F.lit(300.0))).otherwise(F.lit(1.0))
    rfac = F.when(rating.isNotNull() & (rating != 0), rating / F.lit(3.0)).otherwise(F.lit(1.0))
    return event_weight(type_col) * boost * rfac


def days_between(ts, as_of: str) -> Column:
    """Whole days from ``ts`` to ``as_of``, floored (negative in the future).

    Works on TIMESTAMP_NTZ, so it is independent of the session time zone.
    """
    t = _c(ts).cast("timestamp_ntz")
    ref = F.lit(as_of).cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", t, ref)
    return F.floor(micros / F.lit(MICROS_PER_DAY))


def time_decay(ts, as_of: str, halflife_days: float = 30.0, bad_value: float = 0.5) -> Column:
    """2^(-floor(days)/halflife); a missing or unparseable time gives 0.5."""
    d = days_between(ts, as_of)
    return F.coalesce(F.pow(F.lit(2.0), -d / F.lit(float(halflife_days))), F.lit(bad_value))


def freshness(release, as_of: str, halflife_days: float = 90.0) -> Column:
    """2^(-days/halflife); no release date gives 0.5."""
    return time_decay(release, as_of, halflife_days, 0.5)


def rating_factor(rating) -> Column:
    """0.5 + 0.5 * rating / 5 (NULL stays NULL)."""
    return F.lit(0.5) + F.lit(0.5) * (_c(rating) / F.lit(5.0))


def safe_divide(a, b, default: float = 0.0) -> Column:
    """P10."""
    return F.coalesce(F.try_divide(_c(a), F.nullif(_c(b), F.lit(0))), F.lit(default))


def display_score(score) -> Column:
    """Score <= 1 shown x100, else x10, clamped to 0..100."""
    s = _c(score)
    return F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.when(s <= 1, s * 100).otherwise(s * 10)))


def stars(rating) -> Column:
    """Round half to even."""
    return F.bround(_c(rating), 0).cast("int")


def metric_band(value) -> Column:
    """Green / yellow / red."""
    v = _c(value)
    return F.when(v >= 0.3, "green").when(v >= 0.15, "yellow").otherwise("red")


def rank_key(score) -> Column:
    """Q6: quantised score for stable ordering of float ties."""
    return F.round(_c(score), 9)
