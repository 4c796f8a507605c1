"""Numeric expressions: rounding, clamping, finite values, score deltas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_away(value: str | Column, digits: int) -> Column:
    """Scale, round half away from zero, scale back.

    Sums of doubles depend on the order partial results arrive in, so a mean
    that is an exact half-way case may come out one ulp to either side from run
    to run. The scaled value is first rounded to six more digits, which makes
    the outcome independent of partitioning.
    """
    scale = float(10**digits)
    return F.round(F.round(as_col(value) * F.lit(scale), 6), 0) / F.lit(scale)


def round_half_away_sql(expression: str, digits: int) -> str:
    """The same as SQL text, for builders that compose many columns at once."""
    scale = f"{float(10**digits)}D"
    return f"round(round(({expression}) * {scale}, 6), 0) / {scale}"


def clamp(value: str | Column, low: float, high: float) -> Column:
    """Clip to [low, high]; null stays null (greatest/least would skip it)."""
    c = as_col(value)
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(
        F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), c.cast("double")))
    )


def clamp_round(value: str | Column, low: float = 0.0, high: float = 500.0, digits: int = 1) -> Column:
    return round_half_away(clamp(value, low, high), digits)


def null_if_not_finite(value: str | Column) -> Column:
    c = as_col(value)
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def _finite(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return null_if_not_finite(c)
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda item: _finite(item, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(c, lambda _, item: _finite(item, dtype.valueType))
    if isinstance(dtype, T.StructType):
        fields = [_finite(c.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    return c


def finite_frame(df: DataFrame) -> DataFrame:
    """NaN and infinities to null in every column, at any nesting depth."""
    return df.select([_finite(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def improvement_pct(baseline: str | Column, score: str | Column, digits: int = 1) -> Column:
    """Gain over the baseline in percent; the small constant guards a zero baseline."""
    b, s = as_col(baseline), as_col(score)
    return round_half_away((b - s) / (b + F.lit(1e-6)) * 100.0, digits)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
