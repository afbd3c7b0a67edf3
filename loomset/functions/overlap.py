"""Token overlap counts between two token arrays of one row. Nothing here shuffles."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ngrams(tokens: Column, n: int) -> Column:
    """Space-joined n-grams (tokens hold no whitespace); empty when there are fewer than n tokens."""
    if n == 1:
        return tokens
    count = F.size(tokens) - (n - 1)
    last = F.greatest(count, F.lit(0))
    joined = F.slice(tokens, 1, last)
    for shift in range(1, n):
        # A start beyond the end yields an empty slice, so short arrays stay empty.
        following = F.slice(tokens, shift + 1, last)
        joined = F.zip_with(joined, following, lambda a, b: F.concat(a, F.lit(" "), b))
    return joined


def shared_count(left: Column, right: Column) -> Column:
    """Size of the multiset intersection of two string arrays.

    Both sides are sorted together with the left copies of a token first; each right copy then
    uses up one unmatched left copy. One ordered pass, no pairs and no map look-ups.
    """

    def tagged(items: Column, side: int) -> Column:
        return F.transform(items, lambda t: F.struct(t.alias("t"), F.lit(side).alias("s")))

    def state(t: Column, free: Column, shared: Column) -> Column:
        return F.struct(t.alias("t"), free.alias("free"), shared.alias("shared"))

    def step(acc: Column, item: Column) -> Column:
        free = F.when(acc["t"] == item["t"], acc["free"]).otherwise(F.lit(0))
        return (
            F.when(item["s"] == 0, state(item["t"], free + 1, acc["shared"]))
            .when(free > 0, state(item["t"], free - 1, acc["shared"] + 1))
            .otherwise(acc)
        )

    merged = F.array_sort(F.concat(tagged(left, 0), tagged(right, 1)))
    return F.aggregate(merged, state(F.lit(""), F.lit(0), F.lit(0)), step)["shared"]


def lcs_length(a, b) -> int:
    """Length of the longest common subsequence, one bit per position of ``a``.

    The bit-parallel recurrence of Crochemore, Iliopoulos, Pinzon and Reid (2001): a cleared bit
    marks a position where the subsequence grows.
    """
    where: dict[str, int] = {}
    for i, token in enumerate(a):
        where[token] = where.get(token, 0) | (1 << i)
    mask = (1 << len(a)) - 1
    open_bits = mask
    for token in b:
        hit = open_bits & where.get(token, 0)
        if hit:
            open_bits = ((open_bits + hit) | (open_bits - hit)) & mask
    return len(a) - open_bits.bit_count()


COUNTS = ("left", "right", "uni", "bi", "lcs")


@F.pandas_udf(T.StructType([T.StructField(name, T.LongType()) for name in COUNTS]))
def overlap_counts(left: pd.Series, right: pd.Series) -> pd.DataFrame:
    """Token counts, unigram and bigram intersections and the common subsequence of two texts.

    Used when the subsequence is wanted: the texts cross to Python once, as plain strings, which
    measured faster and needs far less memory than handing over token arrays.
    """
    rows = []
    for a, b in zip(left, right):
        a, b = a.lower().split(), b.lower().split()
        uni = (Counter(a) & Counter(b)).total()
        bi = (Counter(zip(a, a[1:])) & Counter(zip(b, b[1:]))).total()
        rows.append((len(a), len(b), uni, bi, lcs_length(a, b)))
    return pd.DataFrame(rows, columns=COUNTS, dtype="int64")


def f1(shared: Column, left_size: Column, right_size: Column) -> Column:
    """F1 of ``shared`` hits; 0 when either side is empty or nothing is shared."""
    precision, recall = shared / left_size, shared / right_size
    return (
        F.when((left_size <= 0) | (right_size <= 0) | (shared == 0), F.lit(0.0))
        .otherwise(2 * precision * recall / (precision + recall))
    )
