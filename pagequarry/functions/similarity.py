"""Similarity of short texts, for gloss matching."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ngrams(x: Column, n: int = 3) -> Column:
    """The set of character n-grams of a text padded with two signs on either side."""
    padded = F.concat(F.lit("##"), x, F.lit("##"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - (n - 1), F.lit(1))), lambda i: F.substr(padded, i, F.lit(n))))


def jaccard(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def dice(a: Column, b: Column) -> Column:
    return 2 * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b))


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.least(F.size(a), F.size(b))


def levenshtein_ratio(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longest)


def similarity(a: Column, b: Column, measure: str = "levenshtein") -> Column:
    """1 for equal texts, 0.9 if one holds the other, else the measure (levenshtein, jaccard, dice or overlap)."""
    if measure == "levenshtein":
        rest = levenshtein_ratio(a, b)
    else:
        rest = {"jaccard": jaccard, "dice": dice, "overlap": overlap}[measure](ngrams(a), ngrams(b))
    return F.when(a == b, 1.0).when(F.contains(a, b) | F.contains(b, a), 0.9).otherwise(rest)
