"""Array math on vector columns, evaluated by JVM higher-order functions (no Python).

Values are promoted to DOUBLE first, so FLOAT inputs are not rounded twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(arr: Column) -> Column:
    return F.transform(arr, lambda x: x.cast("double"))


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)


def softmax(logits: Column, temperature: float = 1.0) -> Column:
    """max-shifted softmax of one row (optionally divided by a temperature first)."""
    z = as_double(logits)
    if temperature != 1.0:
        z = F.transform(z, lambda x: x / F.lit(float(temperature)))
    m = F.array_max(z)
    e = F.transform(z, lambda x: F.exp(x - m))
    total = _sum(e)
    return F.transform(e, lambda x: x / total)


def logsumexp(logits: Column) -> Column:
    """``m + log(sum(exp(x - m)))``, stable for large logits."""
    z = as_double(logits)
    m = F.array_max(z)
    return m + F.log(_sum(F.transform(z, lambda x: F.exp(x - m))))


def gather(arr: Column, index: Column) -> Column:
    """Element at a 0-based index (errors when out of range, like an index into a tensor)."""
    return F.element_at(arr, index.cast("int") + 1)


def token_loss(logits: Column, target: Column) -> Column:
    """A7 per row: ``logsumexp(logits) - logits[target]``."""
    return logsumexp(logits) - gather(as_double(logits), target)


def rms_normalize(x: Column, weight: Sequence[float] | None = None, eps: float = 1e-5) -> Column:
    """``x / sqrt(mean(x^2) + eps) * w``."""
    z = as_double(x)
    rms = F.sqrt(_sum(F.transform(z, lambda v: v * v)) / F.size(z) + F.lit(eps))
    if weight is None:
        return F.transform(z, lambda v: v / rms)
    return F.zip_with(z, F.lit([float(w) for w in weight]), lambda v, w: v / rms * w)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y))


def linear_project(x: Column, weight: Column) -> Column:
    """``W x`` for ``W`` an ARRAY<ARRAY<DOUBLE>> of shape (out, in)."""
    return F.transform(weight, lambda w: dot(w, x))


def lr_schedule(t: Column, a_max: float, a_min: float, warmup: int, cycle: int) -> Column:
    """linear warm-up, cosine decay until ``cycle`` (inclusive), then ``a_min``."""
    t = t.cast("double")
    cos = F.lit(a_min) + F.lit(0.5) * (
        F.lit(1.0) + F.cos((t - F.lit(warmup)) * F.lit(3.141592653589793) / F.lit(float(cycle - warmup)))
    ) * F.lit(a_max - a_min)
    return (
        F.when(t < F.lit(warmup), F.lit(a_max) * t / F.lit(float(warmup)))
        .when(t <= F.lit(cycle), cos)
        .otherwise(F.lit(a_min))
    )
