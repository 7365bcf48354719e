"""M1 linear scoring: y = intercept + sum_i x_i * coef_i, per row.

Runs inside whole-stage codegen as higher-order array functions (no UDF);
measured, an unrolled sum of 64 elements takes three times as long.
float32 features are widened to double before multiplying and summed in
order (H26: compare with a relative tolerance, not bit for bit, against a
float32 accumulator)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def linear_score_expr(features: str | Column, coef: Sequence[float], intercept: float) -> Column:
    """Score of an ``array<float|double>`` column; null when its length
    differs from the coefficient vector."""
    x = F.col(features) if isinstance(features, str) else features
    c = F.array(*[F.lit(float(v)) for v in coef])
    prods = F.zip_with(x, c, lambda a, b: a.cast("double") * b)
    total = F.aggregate(prods, F.lit(0.0), lambda acc, v: acc + v)
    return F.when(F.size(x) == F.lit(len(coef)), total + F.lit(float(intercept)))


def linear_score(df: DataFrame, features: str, coef: Sequence[float], intercept: float,
                 out: str = "score") -> DataFrame:
    return df.withColumn(out, linear_score_expr(features, coef, intercept))


def linear_score_columns(df: DataFrame, cols: Sequence[str], coef: Sequence[float], intercept: float,
                         out: str = "score") -> DataFrame:
    """M1 over scalar feature columns: a generated sum expression."""
    if len(cols) != len(coef):
        raise ValueError("one coefficient per feature column")
    total = F.lit(0.0)
    for c, w in zip(cols, coef):
        total = total + F.col(c).cast("double") * F.lit(float(w))
    return df.withColumn(out, total + F.lit(float(intercept)))
