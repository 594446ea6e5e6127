"""Query registry: importing the modules below fills REGISTRY and ORACLE."""

from __future__ import annotations

import importlib

from rankforge.registry.common import ORACLE, REGISTRY

_MODULES = [
    "popularity_queries",
    "knn_queries",
    "data_queries",
    "eval_queries",
    "model_queries",
    "hybrid_queries",
    "explain_queries",
]


def _load():
    for m in _MODULES:
        importlib.import_module(f"rankforge.registry.{m}")


def all_queries():
    _load()
    return REGISTRY


def all_oracle_sql():
    _load()
    return ORACLE
