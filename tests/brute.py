"""Brute-force single-machine versions of the model semantics, for small fixtures only.

Plain Python and NumPy over collected rows: the slow, obvious way, used as the
second opinion on the Spark operators.
"""

from __future__ import annotations

import math
from collections import defaultdict
from datetime import datetime

import numpy as np

W = {"view": 1.0, "click": 2.0, "like": 4.0, "purchase": 5.0}


def weight(t):
    return W.get(t, 1.0)


def matrix(rows):
    m = defaultdict(float)
    for r in rows:
        m[(r["user_id"], r["item_id"])] += weight(r["interaction_type"])
    return m


def popularity(rows, as_of: str, halflife=30.0):
    ref = datetime.fromisoformat(as_of)
    raw = defaultdict(float)
    for r in rows:
        ts = r["ts"]
        decay = 0.5 if ts is None else 2 ** (-((ref - ts).days) / halflife)
        raw[r["item_id"]] += weight(r["interaction_type"]) * decay
    mx = max(raw.values())
    return {k: v / mx for k, v in raw.items()}


def ordered(scores: dict, n=None):
    out = sorted(scores.items(), key=lambda kv: (-round(kv[1], 9), kv[0]))
    return out if n is None else out[:n]


def cosine_table(m, by_item=True):
    """{(a, b): sim} over ids sharing a key, a != b."""
    vec = defaultdict(dict)
    for (u, i), w in m.items():
        if by_item:
            vec[i][u] = w
        else:
            vec[u][i] = w
    nrm = {k: math.sqrt(sum(x * x for x in v.values())) for k, v in vec.items()}
    keys = sorted(vec)
    out = {}
    for a in keys:
        for b in keys:
            if a == b:
                continue
            d = sum(w * vec[b].get(k, 0.0) for k, w in vec[a].items())
            if d:
                out[(a, b)] = d / (nrm[a] * nrm[b])
    return out


def neighbors(sim, k):
    per = defaultdict(dict)
    for (a, b), s in sim.items():
        if s > 0:
            per[a][b] = s
    return {a: ordered(d, k) for a, d in per.items()}


def item_cf(m, k, users, n):
    nb = neighbors(cosine_table(m, True), k)
    hist = defaultdict(dict)
    for (u, i), w in m.items():
        hist[u][i] = w
    out = {}
    for u in users:
        sc = defaultdict(float)
        for j, w in hist.get(u, {}).items():
            for i, s in nb.get(j, []):
                sc[i] += s * w
        sc = {i: v for i, v in sc.items() if i not in hist.get(u, {})}
        out[u] = ordered(sc, n)
    return out


def user_cf(m, k, users, n):
    nb = neighbors(cosine_table(m, False), k)
    hist = defaultdict(dict)
    for (u, i), w in m.items():
        hist[u][i] = w
    out = {}
    for u in users:
        num, den = defaultdict(float), defaultdict(float)
        for v, s in nb.get(u, []):
            for i, w in hist[v].items():
                num[i] += s * w
                den[i] += abs(s)
        sc = {i: num[i] / den[i] for i in num if den[i] > 0 and i not in hist.get(u, {})}
        out[u] = ordered(sc, n)
    return out


def user_metrics(rec, rel, ks=(5, 10, 20)):
    out = {}
    for k in ks:
        top = rec[:k]
        h = sum(1 for r in top if r in rel)
        p = h / k
        r = h / len(rel) if rel else 0.0
        out[f"precision@{k}"] = p
        out[f"recall@{k}"] = r
        out[f"f1@{k}"] = 0.0 if p + r == 0 else 2 * p * r / (p + r)
        dcg = sum(1 / np.log2(i + 2) for i, it in enumerate(top) if it in rel)
        idcg = sum(1 / np.log2(i + 2) for i in range(min(k, len(rel))))
        out[f"ndcg@{k}"] = dcg / idcg if idcg else 0.0
        out[f"hit_rate@{k}"] = 1.0 if h else 0.0
    hits, ap = 0, 0.0
    for i, it in enumerate(rec):
        if it in rel:
            hits += 1
            ap += hits / (i + 1)
    out["map"] = ap / len(rel) if rel else 0.0
    return out
