"""Vector expressions on ``array<float>`` columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .semantics import as_col


def dot(a: str | Column, b: str | Column) -> Column:
    products = F.zip_with(as_col(a), as_col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: str | Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_similarity(a: str | Column, b: str | Column) -> Column:
    """Cosine in double precision; 0.0 if either vector is all zeros."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))


def vector_literal(values: Sequence[float]) -> Column:
    return F.lit([float(v) for v in values]).cast("array<float>")


def hashed_ngrams(text: str | Column, dim: int = 384, n: int = 3) -> Column:
    """Counts of the n-grams of the characters of a text, hashed into ``dim`` cells, as ``array<float>``.

    A text shorter than ``n`` has no n-gram and gives zeros, as NULL does. The cells of all n-grams are sorted together with one
    marker per cell, so a count is the distance of two ends of runs: no Python, and no pass over the text per cell.
    """

    def codes(chars: Column) -> Column:
        def gram(c: Column, i: Column) -> Column:
            code = c.cast("bigint")
            for k in range(1, n):
                # Bounded below 2^52: three characters of 21 bits and the step stay exact in 64 bits.
                code = (code * 65_599 + F.get(chars, i + k)) % 1_000_000_007
            return (code % dim).cast("int")
        return F.transform(F.slice(chars, F.lit(1), F.size(chars) - (n - 1)), gram)

    def counted(cells: Column) -> Column:
        last = F.size(cells) - 1
        ends = F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | (F.get(cells, i) != F.get(cells, i + 1)))
        # Each cell has one marker, so there are exactly ``dim`` runs.
        return bound(ends, lambda e: F.transform(e, lambda x, d: (x - F.coalesce(F.get(e, d - 1), F.lit(-1)) - 1).cast("float")))

    markers = F.sequence(F.lit(0), F.lit(dim - 1))
    # Every character becomes a number once, and not once a gram. The code of the empty string that a split may leave is dropped.
    split = F.transform(F.filter(F.split(F.coalesce(as_col(text), F.lit("")), ""), lambda c: c != ""), F.ascii)
    found = bound(split, lambda chars: F.when(F.size(chars) >= n, codes(chars)).otherwise(F.array().cast("array<int>")))
    return bound(F.sort_array(F.concat(found, markers)), counted)


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
