"""Similarities of sets and strings as Column expressions; Jaro-Winkler by Arrow."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from linkwright.functions.extract import char_ngrams
from linkwright.functions.text import words


def ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(0.0)


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def jaccard(a: Column, b: Column) -> Column:
    """Of distinct arrays; 0 if either is empty."""
    both = overlap(a, b)
    return F.when((F.size(a) > 0) & (F.size(b) > 0), ratio(both, F.size(a) + F.size(b) - both)).otherwise(0.0)


def string_ratio(a: Column, b: Column) -> Column:
    """Jaccard of bigrams; 0 if either is empty, 1 if they are equal."""
    return F.when((a == "") | (b == ""), 0.0).when(a == b, 1.0).otherwise(jaccard(char_ngrams(a, 2), char_ngrams(b, 2)))


def sorted_words(c: Column) -> Column:
    return F.array_join(F.array_sort(words(c)), " ")


def token_sort_ratio(a: Column, b: Column) -> Column:
    return string_ratio(sorted_words(a), sorted_words(b))


def jaro_winkler_score(a: str, b: str) -> float:
    """Jaro with half transpositions kept and a prefix bonus of up to four characters at any similarity."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    window = max(max(len(a), len(b)) // 2 - 1, 0)
    free = [True] * len(b)
    left = []
    for i, ch in enumerate(a):
        lo = max(0, i - window)
        j = b.find(ch, lo, i + window + 1)
        while j >= 0 and not free[j]:
            j = b.find(ch, j + 1, i + window + 1)
        if j >= 0:
            free[j] = False
            left.append(ch)
    m = len(left)
    if not m:
        return 0.0
    right = [ch for ch, f in zip(b, free, strict=True) if not f]
    t = sum(x != y for x, y in zip(left, right, strict=True)) / 2.0
    sim = (m / len(a) + m / len(b) + (m - t) / m) / 3.0
    prefix = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        prefix += 1
    return min(1.0, sim + 0.1 * prefix * (1.0 - sim))


@F.pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([jaro_winkler_score(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="float64")


def f_beta(p: Column, r: Column, beta: float = 0.5) -> Column:
    b = beta * beta
    return F.when(b * p + r > 0, (1 + b) * p * r / (b * p + r)).otherwise(0.0)


def rule_accepts(sim_all: Column, sim_name: Column, same_house: Column, threshold: float = 0.38) -> Column:
    """The rule solver's acceptance."""
    return (sim_all >= threshold) | (same_house & (sim_name >= 0.35)) | ((sim_name >= 0.65) & (sim_all >= 0.28))
