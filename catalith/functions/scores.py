"""Scores, vectors and fingerprints of bits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def confidence(value: Column) -> Column:
    """A number, or null for what is none."""
    return value.cast("string").try_cast("double")


def clamped(value: Column) -> Column:
    """Between 0 and 1; 0 for what is missing, unreadable or NaN."""
    x = confidence(value)
    return F.when(x.isNull() | F.isnan(x), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))


def finite(score: Column) -> Column:
    """0 for a missing, infinite or undefined score."""
    return F.when(score.isNull() | F.isnan(score) | (F.abs(score) == float("inf")), 0.0).otherwise(score)


def edge_status(conf: Column, similarity: Column, least: float, least_similarity: float) -> Column:
    """active when the confidence suffices and, where a floor is set, the similarity too; proposed otherwise."""
    enough = (conf >= least) & (F.lit(least_similarity <= 0) | (F.coalesce(similarity, F.lit(0.0)) >= least_similarity))
    return F.when(F.coalesce(enough, F.lit(False)), "active").otherwise("proposed")


def canonical(src: Column, dst: Column, symmetric: Column) -> tuple[Column, Column]:
    """Symmetric kinds store their ends in order."""
    return F.when(symmetric, F.least(src, dst)).otherwise(src), F.when(symmetric, F.greatest(src, dst)).otherwise(dst)


def verdict(score: Column, threshold: float = 0.5) -> Column:
    """The threshold itself is a match."""
    return F.when(score >= threshold, "match").otherwise("no_match")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """0 where a length is 0 or a value isn't finite."""
    return finite(F.try_divide(dot(a, b), norm(a) * norm(b)))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def difference_bits(values: Column) -> Column:
    """Bits of a 64-bit fingerprint: whether each of the first 64 values is over its right neighbour, the first one highest."""
    return F.aggregate(F.transform(F.sequence(F.lit(1), F.least(F.lit(64), F.size(values) - 1)), lambda i: (F.element_at(values, i) > F.element_at(values, i + 1)).cast("long")), F.lit(0).cast("long"), lambda s, b: F.shiftleft(s, 1).bitwiseOR(b))


def padded(vector: Column, width: int) -> Column:
    """Zeros up to the stored width."""
    return F.concat(vector, F.array_repeat(F.lit(0.0).cast("float"), F.greatest(F.lit(0), width - F.size(vector))))
