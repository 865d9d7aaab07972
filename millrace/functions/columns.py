"""Row-level math on scalar and array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(array: Column) -> Column:
    return array.cast("array<double>")


def with_one(features: Column) -> Column:
    """Append the constant 1."""
    return F.concat(features, F.array(F.lit(1.0)))


def parity(label: Column) -> Column:
    return F.pmod(label, F.lit(2))


def to_plus_minus(label01: Column) -> Column:
    """{0, 1} to {-1, +1}."""
    return label01 * 2 - 1


def pair_label(label: Column, first: int, second: int) -> Column:
    """first -> +1, second -> -1, anything else NULL."""
    return F.when(label == first, 1).when(label == second, -1)


def binarize(value: Column, threshold: float = 8.0) -> Column:
    """1.0 from the threshold upwards."""
    return (value >= F.lit(float(threshold))).cast("double")


def array_sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda total, v: total + v)


def exact_sum(value: Column) -> Column:
    """Sum of a BIGINT column as DECIMAL(32, 0): the halves of 32 bits are added apart, so that no sum overflows."""
    high, low = F.sum(F.shiftright(value, 32)), F.sum(value.bitwiseAND(F.lit(0xFFFFFFFF)))
    return (high.cast("decimal(19,0)") * F.lit(1 << 32).cast("decimal(12,0)") + low.cast("decimal(19,0)")).cast("decimal(32,0)")


def dot(left: Column, right: Column) -> Column:
    return array_sum(F.zip_with(left, right, lambda a, b: a * b))


def constant_array(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def linear_score(features: Column, weights, bias: float = 0.0) -> Column:
    return dot(features, constant_array(weights)) + F.lit(float(bias))


def linear_score_columns(columns: list[Column], weights, bias: float = 0.0) -> Column:
    """Score over scalar columns; stays in generated code."""
    score = F.lit(float(bias))
    for column, weight in zip(columns, weights):
        score = score + column * F.lit(float(weight))
    return score


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def softmax(scores: Column) -> Column:
    """Softmax of an array, shifted by its maximum."""
    exponents = F.transform(scores, lambda v: F.exp(v - F.array_max(scores)))
    return F.transform(exponents, lambda v: v / array_sum(exponents))


def relu(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0))


def relu_slope(x: Column) -> Column:
    return (x > 0).cast("int")


def probability_hit(target: Column, probability: Column) -> Column:
    """Within one half of the target; exactly one half is a hit for both classes."""
    return F.abs(target - probability) <= 0.5


def argmax(scores: Column) -> Column:
    """Position of the largest entry, lowest position on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def sign_label(score: Column) -> Column:
    return F.when(score > 0, 1).otherwise(-1)


def lp_distance(a: Column, b: Column, p: int = 2) -> Column:
    total = array_sum(F.zip_with(a, b, lambda x, y: F.pow(F.abs(x - y), F.lit(float(p)))))
    return F.pow(total, F.lit(1.0 / p))


def kernel(a: Column, b: Column, kind: str = "rbf", gamma: float = 1.0, degree: int = 2) -> Column:
    """'poly': (gamma a.b + 1)**degree; every other name is the radial kernel."""
    if kind == "poly":
        return F.pow(F.lit(float(gamma)) * dot(a, b) + 1.0, F.lit(float(degree)))
    squared = array_sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))
    return F.exp(F.lit(-float(gamma)) * squared)


def log_normal_density(x: Column, mean: Column, variance: Column) -> Column:
    return -0.5 * F.ln(F.lit(6.283185307179586) * variance) - (x - mean) * (x - mean) / (2.0 * variance)


def clip(x: Column, low: Column, high: Column) -> Column:
    return F.greatest(F.least(x, high), low)


def guarded_ln(x: Column, floor: float = 1e-15) -> Column:
    """Natural log with the argument kept at or above a floor."""
    return F.ln(F.greatest(x, F.lit(floor)))


def guarded_ratio(numerator: Column, denominator: Column, otherwise: float = 0.0) -> Column:
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(otherwise))


def even_grid(start: Column, stop: Column, n: int) -> Column:
    """Array of n even steps, both ends included."""
    if n < 2:
        return F.array(start.cast("double"))
    return F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)), lambda i: start + i * (stop - start) / F.lit(float(n - 1))
    )


def log_grid(start: float, stop: float, n: int) -> Column:
    """Array of n steps even in the logarithm."""
    low, high = F.ln(F.lit(float(start))), F.ln(F.lit(float(stop)))
    return F.transform(even_grid(low, high, n), lambda v: F.exp(v))


def powers(x: Column, order: int) -> Column:
    """x**1 .. x**order."""
    return F.transform(F.sequence(F.lit(1), F.lit(order)), lambda i: F.pow(x, i.cast("double")))


def l2_normalized(array: Column) -> Column:
    """Divide by the Euclidean length; a zero row stays zero."""
    length = F.sqrt(dot(array, array))
    return F.when(length > 0, F.transform(array, lambda v: v / length)).otherwise(array)
