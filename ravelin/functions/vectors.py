"""Vector expressions: float storage, double arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCORE_DIGITS = 10  # scores are compared at this resolution, so equal scores tie whatever the summing order


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y))


def norm(vector: Column) -> Column:
    return F.sqrt(total(F.transform(as_double(vector), lambda x: x * x)))


def normalized(vector: Column) -> Column:
    """v / |v| in double; a zero vector is returned unchanged."""
    values = as_double(vector)
    return F.aggregate(
        F.array(norm(vector)),
        values,
        lambda v, length: F.when(length > 0, F.transform(v, lambda x: x / length)).otherwise(v),
    )


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(total(F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y))))


def cosine(a: Column, b: Column) -> Column:
    lengths = norm(a) * norm(b)
    return F.when(lengths > 0, dot(a, b) / lengths).otherwise(F.lit(0.0))


def score(metric: str, a: Column, b: Column) -> Column:
    """Larger is better for every metric, so Euclidean is the negated distance."""
    forms = {"cosine": cosine, "dot_product": dot, "euclidean": lambda x, y: F.negative(distance(x, y))}
    if metric not in forms:
        raise ValueError(f"no metric called {metric!r}: {tuple(forms)}")
    return F.round(forms[metric](a, b), SCORE_DIGITS)


def int8_codes(vector: Column, low: float, high: float) -> Column:
    width = high - low
    if width <= 0:
        raise ValueError(f"quantization bounds must widen: low {low}, high {high}")
    return F.transform(
        as_double(vector),
        lambda x: (F.round((F.least(F.greatest(x, F.lit(low)), F.lit(high)) - low) / width * 255) - 128).cast("tinyint"),
    )


def sign_words(vector: Column) -> Column:
    """One bit per dimension (v > 0), 64 to a bigint, lowest bit first."""
    bits = F.transform(as_double(vector), lambda x: F.when(x > 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint"))
    starts = F.sequence(F.lit(1), F.size(vector), F.lit(64))
    return F.transform(
        starts,
        lambda s: F.aggregate(
            F.reverse(F.slice(bits, s, F.lit(64))), F.lit(0).cast("bigint"), lambda acc, b: F.shiftleft(acc, 1).bitwiseOR(b)
        ),
    )
