"""Fuzzy similarities of short strings, 0 to 100, from the longest common subsequence."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, on bit vectors."""
    at: dict[str, int] = {}
    for j, c in enumerate(b):
        at[c] = at.get(c, 0) | 1 << j
    full = (1 << len(b)) - 1
    v = full
    for c in a:
        u = v & at.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return len(b) - v.bit_count()


def indel(a: str, b: str) -> float:
    """Twice the common length over both lengths. Two empty strings are equal."""
    return 100.0 if not a and not b else 200.0 * common_length(a, b) / (len(a) + len(b))


def token_sort(a: str, b: str) -> float:
    """Similarity with the words in order."""
    return indel(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """Best similarity of the shared words with either side's and of both sides' with each other. 0 if a side is blank."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not only_x or not only_y):
        return 100.0
    left, right = f"{both} {only_x}".strip(), f"{both} {only_y}".strip()
    scores = [indel(left, right)]
    if both:
        scores += [indel(both, left), indel(both, right)]
    return max(scores)


def _udf(f):
    @F.pandas_udf(T.DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else f(x, y) for x, y in zip(a, b)], dtype="float64")

    return run


token_sort_ratio = _udf(token_sort)
token_set_ratio = _udf(token_set)
