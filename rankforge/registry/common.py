"""Shared pieces of the query registry: the decorator and the oracle SQL views.

Every registered query is a function ``(spark, sf_dir) -> DataFrame`` over the
driver's tables; its oracle is DuckDB SQL over the same tables, written
independently (brute force where that is simpler).  Doubles are rounded to 6
places on both sides, scores are ordered by ``round(score, 9) DESC, id ASC``.
"""

from __future__ import annotations

from rankforge.sources import fixtures as fx

REGISTRY: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


AS_OF_L = fx.AS_OF_L
AS_OF_E = fx.AS_OF_E

# Views of fixture L as CTEs; unused ones cost nothing in DuckDB.
L_VIEWS = (f"WITH interactions AS ({fx.SQL_INTERACTIONS_L}),\n"
           f"items AS ({fx.SQL_ITEMS_L}),\n"
           f"users AS ({fx.SQL_USERS_L})")
E_VIEWS = (f"WITH interactions AS ({fx.SQL_INTERACTIONS_E}),\n"
           f"items AS ({fx.SQL_ITEMS_E})")


def L(body: str) -> str:
    """Fixture-L query text: ``body`` continues the WITH list (starts with ',') or is a SELECT."""
    body = body.strip()
    return L_VIEWS + ("\n" if body.startswith(",") else "\n") + body


def E(body: str) -> str:
    body = body.strip()
    return E_VIEWS + "\n" + body


def W_SQL(col: str = "interaction_type") -> str:
    return (f"CAST(CASE {col} WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'like' THEN 4 "
            f"WHEN 'purchase' THEN 5 ELSE 1 END AS DOUBLE)")


def DAYS_SQL(ts: str, as_of: str) -> str:
    return f"floor((epoch_us(TIMESTAMP '{as_of}') - epoch_us({ts})) / 86400000000)"


def DECAY_SQL(ts: str, as_of: str, halflife: float = 30) -> str:
    return (f"coalesce(pow(CAST(2 AS DOUBLE), -{DAYS_SQL(ts, as_of)} / CAST({halflife} AS DOUBLE)), "
            f"CAST(0.5 AS DOUBLE))")


def users_of(spark, sf):
    return fx.users_l(spark, sf)


# Parameters really used by the reference's runs.
N_RECS = 10
USER_CF_K = 30
ITEM_CF_K = 20
SVD_FACTORS = 30
COLD_THRESHOLD_L = 20     # L has almost no users under 5 lines (FIXTURES.md)
