"""Imputation, duplicate removal and outlier bounds.

All of it is learned on training rows and replayed as literals, so replaying is a projection.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.functions.cells import null_if_missing
from palisade.operators.quantiles import exact_quantiles
from palisade.operators.sketches import approximate_bounds, column_sketches
from palisade.schema import quoted

MASK_BITS = 62


def most_frequent(df: DataFrame, columns: list[str]) -> dict[str, object]:
    """Most frequent non-missing value of each column; a draw goes to the smallest value.

    Values are counted in a distributed aggregation first, so no task holds all the distinct
    values of a column.
    """
    if not columns:
        return {}
    long = df.select(*[null_if_missing(df, c).alias(c) for c in columns]).unpivot(
        [], [F.col(quoted(c)) for c in columns], "column", "value"
    )
    counted = long.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("rank"), "value")).alias("best"))
    return {r["column"]: r["best"]["value"] for r in best.collect()}


def fill_values(df: DataFrame, numeric: list[str], categorical: list[str], strategy: str) -> dict[str, object]:
    """The replacement of each column, learned from its non-missing values."""
    if strategy == "mean":
        row = (
            df.agg(*[F.avg(null_if_missing(df, c).cast("double")).alias(c) for c in numeric]).first()
            if numeric
            else None
        )
        fills = row.asDict() if row is not None else {}
    elif strategy == "median":
        fills = {c: q[0] for c, q in exact_quantiles(df, numeric, [0.5]).items()}
    elif strategy == "most_frequent":
        doubles = df.select(*[F.col(quoted(c)).cast("double").alias(c) for c in numeric]) if numeric else df
        fills = most_frequent(doubles, numeric)
    else:
        raise ValueError(f"unknown missing-value strategy {strategy!r}")
    fills.update(most_frequent(df, categorical))
    empty = [c for c in [*numeric, *categorical] if fills.get(c) is None]
    if empty:
        raise ValueError(f"nothing to learn a replacement from in {empty}")
    return fills


def impute(df: DataFrame, fills: dict[str, object]) -> DataFrame:
    """Replace missing cells; numeric columns become double."""
    columns = {}
    for c, fill in fills.items():
        if c not in df.columns:
            continue
        cell = null_if_missing(df, c)
        if not isinstance(fill, str):
            cell, fill = cell.cast("double"), float(fill)
        columns[c] = F.coalesce(cell, F.lit(fill))
    return df.withColumns(columns)


def _mask_names(n: int) -> list[str]:
    return [f"_gaps_{i}" for i in range((n + MASK_BITS - 1) // MASK_BITS)]


def first_of_each(
    df: DataFrame, features: list[str], row_id: str, label: str, fills: dict[str, object] | None = None
) -> DataFrame:
    """Keep the row with the smallest id among rows whose imputed features agree.

    The label of that row survives with it.  The result carries the *raw* row: which cells were
    missing travels through the aggregation as bits of a number, so the buffers stay fixed-width
    (hash aggregation with map-side combining) and no join back to the input is needed.  Whole and
    decimal numbers, which the doubles of the group key may not hold exactly, travel as they are.
    """
    fills = fills or {}
    gaps = [c for c in features if c in fills]
    masks = []
    for i, name in enumerate(_mask_names(len(gaps))):
        part = gaps[i * MASK_BITS : (i + 1) * MASK_BITS]
        bits = [
            F.when(null_if_missing(df, c).isNull(), F.lit(1 << b)).otherwise(F.lit(0)).cast("bigint")
            for b, c in enumerate(part)
        ]
        masks.append(reduce(lambda a, b: a.bitwiseOR(b), bits).alias(name))
    kinds = dict(df.dtypes)
    exact = {c: f"_raw_{i}" for i, c in enumerate(gaps) if kinds[c] == "bigint" or kinds[c].startswith("decimal")}
    filled = impute(df.select("*", *masks, *[F.col(quoted(c)).alias(name) for c, name in exact.items()]), fills)
    unique = filled.groupBy(*[F.col(quoted(c)) for c in features]).agg(
        F.min(quoted(row_id)).alias(row_id),
        F.min_by(quoted(label), quoted(row_id)).alias(label),
        *[F.min_by(m, quoted(row_id)).alias(m) for m in [*_mask_names(len(gaps)), *exact.values()]],
    )

    def raw(c: str) -> Column:
        if c in exact:
            return F.col(exact[c]).alias(c)
        value = F.col(quoted(c))
        if c in gaps:
            at = gaps.index(c)
            bit = F.col(f"_gaps_{at // MASK_BITS}").bitwiseAND(F.lit(1 << (at % MASK_BITS)))
            value = F.when(bit == 0, value)
        return value.cast(kinds[c]).alias(c)

    return unique.select(F.col(quoted(row_id)), *[raw(c) for c in features], F.col(quoted(label)))


def outlier_bounds(
    df: DataFrame, columns: list[str], method: str | None, multiplier: float = 1.5, *, approximate: bool = False
) -> dict[str, tuple[float, float]]:
    """Accepted range of each column; columns without spread have no z-score range.

    ``approximate`` takes quartiles from sketches in one pass (their rank error is ``sketches.rank_error()``).
    """
    if not method or not columns:
        return {}
    if method == "iqr" and approximate:
        return approximate_bounds(column_sketches(df, columns), multiplier)
    if method == "iqr":
        bounds = {}
        for c, (q1, q3) in exact_quantiles(df, columns, [0.25, 0.75]).items():
            if q1 is not None:
                bounds[c] = (q1 - multiplier * (q3 - q1), q3 + multiplier * (q3 - q1))
        return bounds
    if method == "zscore":
        row = df.agg(
            *[F.avg(quoted(c)).alias(f"{c}:mean") for c in columns],
            *[F.stddev_pop(quoted(c)).alias(f"{c}:std") for c in columns],
        ).first().asDict()
        return {
            c: (row[f"{c}:mean"] - 3 * row[f"{c}:std"], row[f"{c}:mean"] + 3 * row[f"{c}:std"])
            for c in columns
            if row[f"{c}:std"]
        }
    raise ValueError(f"unknown outlier method {method!r}")


def drop_outliers(
    df: DataFrame, bounds: dict[str, tuple[float, float]], fills: dict[str, object] | None = None
) -> DataFrame:
    """Drop a row when any bounded column lies strictly outside its range.

    A missing cell is judged by its replacement in ``fills``; without one it never drops a row.
    """
    if not bounds:
        return df
    fills = fills or {}
    outside = []
    for c, (low, high) in bounds.items():
        value = F.coalesce(null_if_missing(df, c), F.lit(fills.get(c)))
        outside.append(F.coalesce((value < F.lit(low)) | (value > F.lit(high)), F.lit(False)))
    return df.filter(~reduce(or_, outside))
