"""Vector expressions over arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def truncate(a: Column, size: int) -> Column:
    """The first ``size`` dimensions; a shorter vector is an error."""
    return F.when(F.size(a) >= size, F.slice(a, 1, size)).otherwise(F.raise_error(F.lit(f"vector shorter than {size}")))


def minmax(x: Column, low: Column, high: Column) -> Column:
    """Scaled to 0..1 between the two bounds; 1 where they are equal."""
    return F.when(high == low, F.lit(1.0)).otherwise((x - low) / (high - low))


def sign_bits(v: Column, start: int, count: int) -> Column:
    """One bit a dimension, set where it is positive, of up to 63 dimensions from ``start``."""
    part = F.slice(v, start + 1, count)
    return F.aggregate(F.transform(part, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, x: a + x)


def hashed_counts(words: Column, size: int) -> Column:
    """Words counted in ``size`` buckets of their MD5: an embedding that needs no model and is the same everywhere."""
    bucket = F.transform(words, lambda w: F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long") % size)
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda b: F.size(F.filter(bucket, lambda x: x == b)).cast("double"))
