"""Vector similarities and distances over ``array`` columns, and over ML vectors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

NAN = float("nan")


def as_doubles(vec: Column) -> Column:
    return vec.cast("array<double>")


def _total(vec: Column) -> Column:
    return F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y))


def _ratio(num: Column, den: Column) -> Column:
    return F.when((den == 0) | F.isnan(den), F.lit(NAN)).otherwise(num / den)


def _same_length(a: Column, b: Column, value: Column, on_mismatch: str) -> Column:
    differs = F.size(a) != F.size(b)
    if on_mismatch == "null":
        return F.when(differs, F.lit(None).cast("double")).otherwise(value)
    message = F.concat(
        F.lit("vectors differ in length: "), F.size(a).cast("string"), F.lit(" and "), F.size(b).cast("string")
    )
    return F.when(differs, F.raise_error(message).cast("double")).otherwise(value)


def cosine(a: Column, b: Column, on_mismatch: str = "error") -> Column:
    """Dot product over the product of norms; NaN when either norm is zero."""
    value = _ratio(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
    return _same_length(a, b, value, on_mismatch)


def pearson(a: Column, b: Column, on_mismatch: str = "error") -> Column:
    """Pearson correlation of the centred vectors; NaN when either vector is constant."""

    def centred(vec: Column) -> Column:
        whole = as_doubles(vec)
        # A one-element transform holds the mean, so that it is not worked out per component.
        means = F.array(_total(whole) / F.size(vec))
        moved = F.get(F.transform(means, lambda m: F.transform(whole, lambda v: v - m)), 0)
        # Rounding must not give a constant vector a direction.
        return F.when(F.array_min(whole) == F.array_max(whole), F.transform(whole, lambda v: F.lit(0.0))).otherwise(moved)

    def compare(pair: Column) -> Column:
        x, y = pair["x"], pair["y"]
        return _ratio(dot(x, y), F.sqrt(dot(x, x)) * F.sqrt(dot(y, y)))

    shifted = F.array(F.struct(centred(a).alias("x"), centred(b).alias("y")))
    value = F.when(F.size(a) == 0, F.lit(NAN)).otherwise(F.get(F.transform(shifted, compare), 0))
    return _same_length(a, b, value, on_mismatch)


def adjusted_cosine(a: Column, b: Column, on_mismatch: str = "error") -> Column:
    """Cosine after taking one mean, common to both vectors, off every component."""
    mean = (_total(as_doubles(a)) + _total(as_doubles(b))) / (F.size(a) + F.size(b))

    def minus(vec: Column) -> Column:
        # A one-element transform holds the mean, so that it is not worked out per component.
        return F.get(F.transform(F.array(mean), lambda m: F.transform(as_doubles(vec), lambda v: v - m)), 0)

    def compare(pair: Column) -> Column:
        x, y = pair["x"], pair["y"]
        return _ratio(dot(x, y), F.sqrt(dot(x, x)) * F.sqrt(dot(y, y)))

    shifted = F.array(F.struct(minus(a).alias("x"), minus(b).alias("y")))
    value = F.when(F.size(a) == 0, F.lit(NAN)).otherwise(F.get(F.transform(shifted, compare), 0))
    return _same_length(a, b, value, on_mismatch)


def squared_distance(a: Column, b: Column) -> Column:
    return _total(F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: (x - y) * (x - y)))


def euclidean(a: Column, b: Column, on_mismatch: str = "error") -> Column:
    return _same_length(a, b, F.sqrt(squared_distance(a, b)), on_mismatch)


METRICS = {
    "cosine": cosine,
    "pearson": pearson,
    "adjusted_cosine": adjusted_cosine,
    "euclidean": euclidean,
}


def for_vectors(metric: Callable[..., Column]) -> Callable[..., Column]:
    """The same measure over two columns of ML vectors, dense or sparse."""

    def run(a: Column, b: Column, on_mismatch: str = "error") -> Column:
        return metric(vector_to_array(a), vector_to_array(b), on_mismatch)

    return run


VECTOR_METRICS = {name: for_vectors(metric) for name, metric in METRICS.items()}
