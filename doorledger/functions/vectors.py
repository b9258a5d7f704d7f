"""Vector measures as array expressions, computed in double precision.

They suit one vector pair per row. For one-against-many search use
``operators.similarity``, which multiplies whole Arrow batches instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_THRESHOLD = 0.6


def _d(v: Column | str) -> Column:
    return (F.col(v) if isinstance(v, str) else v).cast("array<double>")


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column | str, b: Column | str) -> Column:
    return _sum(F.zip_with(_d(a), _d(b), lambda x, y: x * y))


def norm(a: Column | str) -> Column:
    return F.sqrt(_sum(F.transform(_d(a), lambda x: x * x)))


def cosine_similarity(a: Column | str, b: Column | str) -> Column:
    """Null when either vector has no length."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def cosine_distance(a: Column | str, b: Column | str) -> Column:
    return F.lit(1.0) - cosine_similarity(a, b)


def euclidean(a: Column | str, b: Column | str) -> Column:
    return F.sqrt(_sum(F.zip_with(_d(a), _d(b), lambda x, y: (x - y) * (x - y))))


def euclidean_l2(a: Column | str, b: Column | str) -> Column:
    def unit(v: Column | str) -> Column:
        n = norm(v)
        return F.transform(_d(v), lambda x: F.try_divide(x, n))
    return euclidean(unit(a), unit(b))


_METRICS = {"cosine": cosine_similarity, "euclidean": euclidean, "euclidean_l2": euclidean_l2}


def similarity(a: Column | str, b: Column | str, metric: str = "cosine") -> Column:
    if metric not in _METRICS:
        raise ValueError(f"Unknown metric: {metric}")
    return _METRICS[metric](a, b)


def effective_threshold(threshold: float | None) -> float:
    """None and 0 both mean "not set"."""
    return threshold or DEFAULT_THRESHOLD


def verify_pair(a: Column | str, b: Column | str,
                threshold: float = DEFAULT_THRESHOLD) -> Column:
    """(same person?, similarity); a missing vector gives (false, 0.0)."""
    missing = _d(a).isNull() | _d(b).isNull()
    sim = cosine_similarity(a, b)
    return F.struct(
        F.when(missing, F.lit(False)).otherwise(F.coalesce(sim >= threshold, F.lit(False)))
        .alias("is_same"),
        F.when(missing, F.lit(0.0)).otherwise(sim).alias("similarity"))


def vector_from_json(text: Column | str) -> Column:
    return F.from_json(text, "array<float>")
