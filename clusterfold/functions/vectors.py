"""Vector arithmetic as Spark column expressions (V1-V7).

Vectors are ``array<double>`` columns. Two families of builders exist:

* column-with-column (``vadd``, ``vdot``, ``vdist`` ...): higher-order
  functions (``zip_with``, ``aggregate``), for two array columns of a row;
* column-with-constant (``dot_const``, ``sq_dist_const`` ...): the constant
  vector is unrolled into plain arithmetic on ``x[i]``, which stays inside
  whole-stage codegen.  Used in the hot loops (K-means assignment, gradient
  sums) where the other operand is a small driver-side vector.

Equal length is a precondition (a Scala ``zip`` truncates, Spark's
``zip_with`` pads with NULL); ``require_length`` turns a violation into a
task failure instead of a silent NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- column with column (higher-order functions) -------------------------


def vadd(a: Column | str, b: Column | str) -> Column:
    """V1 element-wise sum."""
    return F.zip_with(_col(a), _col(b), lambda x, y: x + y)


def vsub(a: Column | str, b: Column | str) -> Column:
    """V3 element-wise difference."""
    return F.zip_with(_col(a), _col(b), lambda x, y: x - y)


def hadamard(a: Column | str, b: Column | str) -> Column:
    """V5 element-wise product."""
    return F.zip_with(_col(a), _col(b), lambda x, y: x * y)


def vscale(a: Column | str, s: Column | float) -> Column:
    """V4 vector times scalar."""
    s = s if isinstance(s, Column) else F.lit(float(s))
    return F.transform(_col(a), lambda x: x * s)


def vsum(a: Column | str) -> Column:
    """Sum of the elements (left to right)."""
    return F.aggregate(_col(a), F.lit(0.0), lambda acc, v: acc + v)


def vdot(a: Column | str, b: Column | str) -> Column:
    """V2 dot product."""
    return vsum(hadamard(a, b))


def vdist(a: Column | str, b: Column | str) -> Column:
    """V6 Euclidean distance."""
    diff2 = F.zip_with(_col(a), _col(b), lambda x, y: (x - y) * (x - y))
    return F.sqrt(vsum(diff2))


def zeros(n: int | Column) -> Column:
    """V7 zero vector of length n (an int or an int column)."""
    return F.array_repeat(F.lit(0.0), n)


def as_double_array(c: Column | str) -> Column:
    """Cast any numeric array (e.g. ``array<float>``) to ``array<double>``."""
    return _col(c).cast("array<double>")


# ---- column with driver-side constant (unrolled, codegen friendly) --------


def dot_const(x: Column | str, w: Sequence[float]) -> Column:
    """x . w for a constant vector w, as plain arithmetic on x[i]."""
    x = _col(x)
    expr = None
    for i, wi in enumerate(w):
        term = x[i] * F.lit(float(wi))
        expr = term if expr is None else expr + term
    return expr if expr is not None else F.lit(0.0)


def sq_dist_const(x: Column | str, c: Sequence[float]) -> Column:
    """Squared Euclidean distance from x to a constant vector c."""
    x = _col(x)
    expr = None
    for i, ci in enumerate(c):
        diff = x[i] - F.lit(float(ci))
        term = diff * diff
        expr = term if expr is None else expr + term
    return expr if expr is not None else F.lit(0.0)


def dist_const(x: Column | str, c: Sequence[float]) -> Column:
    """Euclidean distance from x to a constant vector c."""
    return F.sqrt(sq_dist_const(x, c))


def require_length(x: Column | str, n: int, what: str = "vector") -> Column:
    """Predicate that is TRUE for rows whose array has length n and raises
    otherwise. Use it in ``where``: a filter is never pruned away, unlike a
    projected column nobody reads."""
    x = _col(x)
    return F.when(
        F.size(x) == n, F.lit(True)
    ).otherwise(F.raise_error(F.lit(f"{what} length differs from {n}")))


def require_same_length(a: Column | str, b: Column | str) -> Column:
    """Predicate: TRUE when both arrays have the same length, raises otherwise."""
    return F.when(F.size(_col(a)) == F.size(_col(b)), F.lit(True)).otherwise(
        F.raise_error(F.lit("vector lengths differ"))
    )
