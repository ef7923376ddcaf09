"""Cell cleaning, label and decision expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.config import CLASS_NAMES, NORMAL_LABEL
from palisade.schema import quoted

_FLOATING = (T.FloatType, T.DoubleType)


def missing(df: DataFrame, name: str) -> Column:
    """Null and NaN are one thing."""
    c = F.col(quoted(name))
    if isinstance(df.schema[name].dataType, _FLOATING):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def null_if_missing(df: DataFrame, name: str) -> Column:
    """The cell with NaN turned into null, otherwise untouched."""
    c = F.col(quoted(name))
    if isinstance(df.schema[name].dataType, _FLOATING):
        return F.when(~F.isnan(c), c)
    return c


def finite_or_zero(c: Column) -> Column:
    """Cast to double; null, NaN and both infinities become 0.0."""
    d = c.cast("double")
    return F.when(d.isNull() | F.isnan(d) | (F.abs(d) == float("inf")), F.lit(0.0)).otherwise(d)


def finite_table(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: finite_or_zero(F.col(quoted(c))) for c in columns})


def binary_label(label: Column, normal: str = NORMAL_LABEL) -> Column:
    """0 for the normal label, 1 for every other value, null included."""
    return F.when(label.eqNullSafe(F.lit(normal)), 0).otherwise(1)


def with_binary_label(df: DataFrame, label: str = "label", normal: str = NORMAL_LABEL) -> DataFrame:
    return df.withColumn(label, binary_label(F.col(quoted(label)), normal))


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; names that are absent are ignored."""
    return df.drop(*names)


def align(df: DataFrame, features: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly ``features`` in this order after the kept columns; absent ones become 0.0."""
    have = set(df.columns)
    kept = [F.col(quoted(c)) for c in keep if c in have]
    return df.select(
        *kept, *[F.col(quoted(c)) if c in have else F.lit(0.0).alias(c) for c in features]
    )


def decide(p: Column, threshold: float) -> Column:
    """1 when the probability reaches the threshold; the boundary counts."""
    return (p >= F.lit(float(threshold))).cast("int")


def verdict(prediction: Column) -> Column:
    return F.when(prediction == 1, CLASS_NAMES[1]).otherwise(CLASS_NAMES[0])


def confidence(p: Column) -> Column:
    """Probability of the more likely class, whatever the threshold says."""
    return F.greatest(p, F.lit(1.0) - p)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives 0.0 for an empty denominator."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in the stated order, for a scoring preview."""
    return df.orderBy(*[F.col(quoted(c)).asc_nulls_first() for c in order]).limit(n)
