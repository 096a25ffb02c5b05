"""Token-set similarity of two names, 0 to 100."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F, types as T


def common_subsequence(x: str, y: str) -> int:
    """Length of the longest common subsequence, one machine-word step per letter of ``y``."""
    if not x or not y:
        return 0
    where: dict[str, int] = {}
    for i, char in enumerate(x):
        where[char] = where.get(char, 0) | 1 << i
    full = (1 << len(x)) - 1
    row = full
    for char in y:
        hit = row & where.get(char, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(x) - row.bit_count()


def token_set_score(a: str | None, b: str | None) -> float:
    """Compare the shared words, and the shared words plus each side's rest; the best of the three counts."""
    left, right = set((a or "").split()), set((b or "").split())
    if not left or not right:
        return 0.0
    shared = " ".join(sorted(left & right))
    only_left, only_right = " ".join(sorted(left - right)), " ".join(sorted(right - left))
    if shared and (not only_left or not only_right):
        return 100.0
    gap = 1 if shared else 0
    len_left, len_right = len(shared) + gap + len(only_left), len(shared) + gap + len(only_right)
    edits = len(only_left) + len(only_right) - 2 * common_subsequence(only_left, only_right)
    score = 100.0 * (1 - edits / (len_left + len_right))
    if shared:
        score = max(
            score,
            100.0 * (1 - (gap + len(only_left)) / (len(shared) + len_left)),
            100.0 * (1 - (gap + len(only_right)) / (len(shared) + len_right)),
        )
    return score


@F.pandas_udf(T.DoubleType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set_score(x, y) for x, y in zip(a, b)], dtype="float64")
