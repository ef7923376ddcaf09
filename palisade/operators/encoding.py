"""Categorical encodings and numeric scaling, learned once and replayed as projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.operators.quantiles import exact_quantiles
from palisade.schema import quoted
from palisade.session import SMALL_TABLE_ROWS, cut_lineage, settle_small


def categories(df: DataFrame, columns: list[str], limit: int | None = None) -> dict[str, list[str]]:
    """Sorted distinct values of each column.

    Each category becomes a column of the encoded table.  With a ``limit``, more of them are an error;
    the check runs on the distributed distinct before anything reaches the driver.
    """
    if not columns:
        return {}
    distinct = (
        df.unpivot([], [F.col(quoted(c)) for c in columns], "column", "value")
        .filter(F.col("value").isNotNull())
        .distinct()
    )
    rows = (distinct if limit is None else distinct.limit(limit + 1)).collect()
    if limit is not None and len(rows) > limit:
        raise ValueError(f"more than {limit} categories in {columns}; raise max_categories or drop a column")
    found: dict[str, list[str]] = {c: [] for c in columns}
    for r in rows:
        found[r["column"]].append(r["value"])
    return {c: sorted(values) for c, values in found.items()}


def indicator_name(column: str, value: str) -> str:
    return f"{column}_{value}"


def indicators(levels: dict[str, list[str]]) -> list[Column]:
    """One 0/1 column per learned category; unseen and missing values give all zeros."""
    return [
        F.when(F.col(quoted(c)) == F.lit(v), 1.0).otherwise(0.0).alias(indicator_name(c, v))
        for c, values in levels.items()
        for v in values
    ]


def code_table(df: DataFrame, columns: list[str], small: int = SMALL_TABLE_ROWS) -> DataFrame:
    """(column, value, code): position of each distinct value among the sorted ones of its column.

    The table is computed once.  With at most ``small`` rows it is a broadcast lookup.  Otherwise
    the values are range-partitioned in a written table and numbered partition by partition, and
    joins on it are left to shuffle.
    """
    distinct = (
        df.select(*[F.col(quoted(c)).cast("string").alias(c) for c in columns])
        .unpivot([], [F.col(quoted(c)) for c in columns], "column", "value")
        .filter(F.col("value").isNotNull())
        .distinct()
    )
    settled, fits = settle_small(distinct, small)
    if fits:
        place = F.row_number().over(Window.partitionBy("column").orderBy("value"))
        return F.broadcast(settled.withColumn("code", (place - 1).cast("int")))

    ranged = cut_lineage(
        settled.repartitionByRange("column", "value").withColumn("_part", F.spark_partition_id()), "codes"
    )
    per_part = ranged.groupBy("column", "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("column").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(  # one row per partition and column
        "column", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    inside = F.row_number().over(Window.partitionBy("column", "_part").orderBy("value"))
    return (
        ranged.withColumn("_place", inside)
        .join(F.broadcast(offsets), ["column", "_part"])
        .select("column", "value", (F.col("_offset") + F.col("_place") - 1).cast("int").alias("code"))
    )


def encode_with(df: DataFrame, codes: DataFrame, column: str, output: str) -> DataFrame:
    """Add the stored code of a column; unseen values get null."""
    mapping = codes.filter(F.col("column") == column).select(
        F.col("value").alias("_value"), F.col("code").alias(output)
    )
    return df.join(mapping, F.col(quoted(column)).cast("string") == F.col("_value"), "left").drop("_value")


def decode_with(df: DataFrame, codes: DataFrame, column: str, code: str, output: str) -> DataFrame:
    """The inverse of :func:`encode_with`."""
    mapping = codes.filter(F.col("column") == column).select(
        F.col("code").alias("_code"), F.col("value").alias(output)
    )
    return df.join(mapping, F.col(quoted(code)) == F.col("_code"), "left").drop("_code")


def scaling(df: DataFrame, columns: list[str], method: str) -> dict[str, tuple[float, float]]:
    """(centre, spread) of each column; a spread of zero is replaced by one."""
    if not columns:
        return {}
    if method == "standard":
        row = df.agg(
            *[F.avg(quoted(c)).alias(f"{c}:centre") for c in columns],
            *[F.stddev_pop(quoted(c)).alias(f"{c}:spread") for c in columns],
        ).first().asDict()
        learned = {c: (row[f"{c}:centre"], row[f"{c}:spread"]) for c in columns}
    elif method == "minmax":
        row = df.agg(
            *[F.min(quoted(c)).alias(f"{c}:low") for c in columns],
            *[F.max(quoted(c)).alias(f"{c}:high") for c in columns],
        ).first().asDict()
        learned = {c: (row[f"{c}:low"], row[f"{c}:high"] - row[f"{c}:low"]) for c in columns}
    elif method == "robust":
        learned = {
            c: (median, q3 - q1) for c, (q1, median, q3) in exact_quantiles(df, columns, [0.25, 0.5, 0.75]).items()
        }
    else:
        raise ValueError(f"unknown scaling method {method!r}")
    return {c: (float(centre), float(spread) or 1.0) for c, (centre, spread) in learned.items()}


def scaled(column: str, centre: float, spread: float) -> Column:
    value = F.col(quoted(column)).cast("double")
    return ((value - F.lit(centre)) / F.lit(spread)).alias(column)
