"""Vector functions over ``array<double>`` columns: one row is one vector."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _a(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, not once per element that mentions it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def as_double(c) -> Column:
    return _a(c).cast("array<double>")


def fsum(a) -> Column:
    return F.aggregate(_a(a), F.lit(0.0), lambda s, x: s + x)


def fmean(a) -> Column:
    return F.try_divide(fsum(a), F.size(_a(a)))


def argmax_last(a) -> Column:
    """Index of the maximum; the last of equal maxima wins."""
    a = _a(a)
    return (F.size(a) - F.array_position(F.reverse(a), F.array_max(a))).cast("int")


def argmax_first(a) -> Column:
    a = _a(a)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def argsort(a, descending: bool = False) -> Column:
    """Indices in sorted order; equal values keep index order."""
    sign = -1.0 if descending else 1.0
    pairs = F.transform(_a(a), lambda x, i: F.struct((x * sign).alias("k"), i.alias("i")))
    return F.transform(F.array_sort(pairs), lambda p: p["i"])


def top_k_indices(a, k: int) -> Column:
    return F.slice(argsort(a, True), 1, k)


def count_equal(a, b) -> Column:
    return F.size(F.filter(F.zip_with(_a(a), _a(b), lambda x, y: x == y), lambda e: e))


def binary(a, b, fn) -> Column:
    return F.zip_with(_a(a), _a(b), fn)


def unary(a, fn) -> Column:
    return F.transform(_a(a), fn)


def sgn(a) -> Column:
    return unary(a, F.signum)


def step(a) -> Column:
    """1 for x > 0, else 0."""
    return unary(a, lambda x: F.when(x > 0, 1.0).otherwise(0.0))


# Constants of the tanh form of GELU: fixed values.
GELU_C = 0.044715
SQRT_2_OVER_PI = 0.79788456080286535587989211986876

ACTIVATIONS = {
    "tanh": F.tanh,
    "elu": lambda x: F.when(x > 0, x).otherwise(F.expm1(x)),
    "relu": lambda x: F.greatest(x, F.lit(0.0)),
    "leaky_relu": lambda x: F.greatest(x, F.lit(0.0)) + F.least(x, F.lit(0.0)) * 0.1,
    "sigmoid": lambda x: 1.0 / (1.0 + F.exp(-x)),
    "gelu": lambda x: x * 0.5 * (1.0 + F.tanh(x * (1.0 + x * x * GELU_C) * SQRT_2_OVER_PI)),
    "gelu_quick": lambda x: x / (1.0 + F.exp(x * -1.702)),
    "silu": lambda x: x / (1.0 + F.exp(-x)),
    "hard_swish": lambda x: x * F.least(F.lit(1.0), F.greatest(F.lit(0.0), (x + 3.0) / 6.0)),
    "hard_sigmoid": lambda x: F.least(F.lit(1.0), F.greatest(F.lit(0.0), (x + 3.0) / 6.0)),
}


def activate(a, kind: str) -> Column:
    return unary(a, ACTIVATIONS[kind])


def sum_sq(a) -> Column:
    return F.aggregate(_a(a), F.lit(0.0), lambda s, x: s + x * x)


def standardise(a, eps: float = 1e-5) -> Column:
    """Mean 0, population variance 1 (plus ``eps``)."""
    a = _a(a)

    def spread(c: Column) -> Column:
        return let(F.sqrt(sum_sq(c) / F.size(c) + eps), lambda s: F.transform(c, lambda x: x / s))

    return let(let(fmean(a), lambda m: F.transform(a, lambda x: x - m)), spread)


def rms_norm(a, eps: float = 1e-6) -> Column:
    a = _a(a)
    return let(F.sqrt(sum_sq(a) / F.size(a) + eps), lambda s: F.transform(a, lambda x: x / s))


def group_norm(a, groups: int, eps: float = 1e-6) -> Column:
    """Standardise each of ``groups`` equal runs of the vector on its own."""
    a = _a(a)
    width = F.ceil(F.size(a) / F.lit(groups)).cast("int")
    runs = F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), lambda g: F.slice(a, g * width + 1, width))
    return F.flatten(F.transform(runs, lambda r: standardise(r, eps)))


def l2_norm(a, eps: float = 1e-12) -> Column:
    """Divide by the larger of the Euclidean length and ``eps``."""
    a = _a(a)
    return let(F.greatest(F.sqrt(sum_sq(a)), F.lit(eps)), lambda s: F.transform(a, lambda x: x / s))


def scale(a, factor: float) -> Column:
    return unary(a, lambda x: x * factor)


def clamp(a, low: float, high: float) -> Column:
    return unary(a, lambda x: F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def pad_zero(a, n: int) -> Column:
    return F.concat(_a(a), F.array_repeat(F.lit(0.0), n))


def pad_reflect(a, left: int, right: int) -> Column:
    """Mirror at both ends; the edge value itself is not repeated."""
    a = _a(a)
    head = F.reverse(F.slice(a, 2, left))
    tail = F.reverse(F.slice(a, F.size(a) - right, right))
    return F.concat(head, a, tail)


def roll(a, shift: int) -> Column:
    """Move every element ``shift`` places to the right, around the end."""
    a = _a(a)
    n = F.size(a)
    cut = F.pmod(F.lit(-shift), n)
    return F.concat(F.slice(a, cut + 1, n), F.slice(a, F.lit(1), cut))


def arange(start: float, stop: float, step_: float) -> Column:
    n = max(0, -int(-(stop - start) // step_))
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.lit(start) + i * step_)


def gather(a, idx) -> Column:
    a = _a(a)
    return F.transform(_a(idx), lambda i: F.get(a, i))


def scatter(a, idx, values) -> Column:
    """``a`` with ``values[k]`` at place ``idx[k]``; of several for one place the last stays, places outside are passed over."""
    a, back = _a(a), F.reverse(_a(idx))
    late = F.reverse(_a(values))
    at = lambda i: F.array_position(back, i).cast("int")
    return F.transform(a, lambda x, i: F.when(at(i) > 0, F.get(late, at(i) - 1)).otherwise(x))


def outer(a, b) -> Column:
    """Matrix ``a[i] * b[j]`` of one row, as an array of rows."""
    b = _a(b)
    return F.transform(_a(a), lambda x: F.transform(b, lambda y: x * y))


def pool(a, k: int, kind: str) -> Column:
    """1-D pooling with stride equal to the kernel; a short tail is left out."""
    a = _a(a)
    n = F.floor(F.size(a) / F.lit(k)).cast("int")
    fn = F.array_max if kind == "max" else fmean
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: fn(F.slice(a, i * k + 1, F.lit(k))))


def softmax(a) -> Column:
    a = _a(a)
    grown = let(F.array_max(a), lambda m: F.transform(a, lambda x: F.exp(x - m)))
    return let(grown, lambda e: let(fsum(e), lambda z: F.transform(e, lambda x: x / z)))


def log_sum_exp(a) -> Column:
    a = _a(a)
    return let(F.array_max(a), lambda m: m + F.ln(F.aggregate(a, F.lit(0.0), lambda s, x: s + F.exp(x - m))))


def cross_entropy(logits, probs) -> Column:
    """``-sum(p * log_softmax(logits))`` of one row; the caller averages over rows."""
    logits, probs = _a(logits), _a(probs)
    return let(log_sum_exp(logits), lambda z: -fsum(F.zip_with(logits, probs, lambda x, p: p * (x - z))))


def dot(a, b) -> Column:
    return fsum(F.zip_with(_a(a), _a(b), lambda x, y: x * y))
