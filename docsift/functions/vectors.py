"""Vector expressions on ``array<float|double>`` columns (higher-order SQL).

Used where a row compares its own vectors (adjacent sentences, a vector
and its centroid).  Query-against-corpus scoring lives in
``operators.search`` (vectorised per Arrow batch instead).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    prods = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 when either side is the zero vector (never NaN)."""
    den = norm(a) * norm(b)
    return F.when(den > 0, dot(a, b) / den).otherwise(F.lit(0.0))


def l2(a: Column, b: Column) -> Column:
    d = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(d, F.lit(0.0).cast("double"), lambda s, x: s + x))


def check_dim(a: Column, dim: int) -> Column:
    """EMB-5: pass the vector through, fail the task if its length is not
    ``dim`` or a component is null, NaN or infinite; null passes."""
    fine = (F.size(a) == dim) & F.forall(a, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(a.isNull() | fine, a).otherwise(
        F.raise_error(F.concat(F.lit(f"embedding must have {dim} finite numbers, got one of "), F.size(a).cast("string"))))
