"""Column algebra over state arrays: components, differences, norms, quaternions. Positions count from 0."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def parts(x: Column | str, at: Sequence[int]) -> list[Column]:
    """Components of an array column."""
    x = F.col(x) if isinstance(x, str) else x
    return [F.get(x, F.lit(i)) for i in at]


def minus(a: Sequence[Column], b: Sequence[Column]) -> list[Column]:
    return [p - q for p, q in zip(a, b, strict=True)]


def dot(a: Sequence[Column], b: Sequence[Column]) -> Column:
    return sum((p * q for p, q in zip(a[1:], b[1:], strict=True)), a[0] * b[0])


def norm(a: Sequence[Column]) -> Column:
    return F.sqrt(dot(a, a).cast("double"))


def round_even(x: Column, digits: int) -> Column:
    """A double rounded half to even as DuckDB's round_even does it: the scaled double decides what is a half. bround() looks at the
    shortest decimal instead, and so rounds another way where scaling makes or breaks a half."""
    scale = 10.0**digits
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def quaternion_angle(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Rotation between two quaternions (w, x, y, z) of any length, in radians; null if one is zero."""
    cosine = F.abs(dot(a, b)) / F.nullif(norm(a) * norm(b), F.lit(0.0))
    return 2 * F.acos(F.least(cosine, F.lit(1.0)))


def multiply(a: Sequence[Column], b: Sequence[Column]) -> list[Column]:
    """Hamilton product."""
    (w, x, y, z), (p, q, r, s) = a, b
    return [w * p - x * q - y * r - z * s, w * q + x * p + y * s - z * r, w * r - x * s + y * p + z * q, w * s + x * r - y * q + z * p]


def log_delta(origin: Sequence[Column], target: Sequence[Column]) -> list[Column]:
    """Rotation vector from origin to target: the logarithm of target times the conjugate of origin, the short way round."""
    w, *v = multiply(target, [origin[0], *[-c for c in origin[1:]]])
    flip = F.when(w < 0, -1).otherwise(1)
    length = norm(v)
    scale = F.when(length == 0, 0.0).otherwise(2 * F.atan2(length, (flip * w).cast("double")) / length)
    return [flip * c * scale for c in v]
