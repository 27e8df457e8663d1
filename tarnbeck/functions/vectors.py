"""Vector arithmetic on arrays, in doubles; scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def double(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(double(a), double(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def cosine(a: Column, b: Column, eps: float = 0.0) -> Column:
    return dot(a, b) / (norm(a) * norm(b) + eps)


def fit_length(v: Column, size: int) -> Column:
    """Cut, or filled up with zeros."""
    return F.slice(F.concat(v, F.array_repeat(F.lit(0.0).cast("float"), size)), 1, size)


#: How stores map a distance or cosine to a score; the engine's own is "cosine".
SCORES = {
    "cosine": lambda c: (c + 1) / 2, "distance": lambda d: (2 - d) / 2, "shifted": lambda c: c + 1,
    "clamped": lambda d: F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - d)), "euclid": lambda d: 1 / (1 + d), "raw": lambda c: c,
}


def late_interaction(query: Column, doc: Column) -> Column:
    """Sum over the query's vectors of the largest dot with any of the document's."""
    return F.aggregate(F.transform(query, lambda q: F.array_max(F.transform(doc, lambda d: dot(q, d)))), F.lit(0.0), lambda s, x: s + x)


def backoff(attempt: Column, base: float = 1.0, most: float = 60.0) -> Column:
    """Seconds before a retry, without jitter."""
    return F.least(F.lit(most), F.lit(base) * F.pow(F.lit(2.0), attempt))


def reward(similarity: Column, penalty: Column, empty: Column) -> Column:
    return 10 * similarity + penalty + F.when(empty, -3.0).otherwise(0.0)
