"""Paths and small helpers that the tests share."""
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_SMALL = "/root/testdata/sf0.001"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
