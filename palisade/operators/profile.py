"""Profiling of a raw table."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.functions.cells import missing, null_if_missing
from palisade.operators.quantiles import exact_quantiles
from palisade.schema import categorical_columns, column_kinds, numeric_columns, quoted


def row_count(df: DataFrame) -> F.Column:
    """Number of rows as a scalar subquery: it reads no columns and needs no join."""
    return df.agg(F.count(F.lit(1))).scalar()


def table_shape(df: DataFrame) -> DataFrame:
    """Rows (section, key, value): row count, column count and a histogram of column types."""
    kinds = Counter(t for _, t in df.dtypes)
    facts = [("shape", "columns", len(df.columns))] + [("dtypes", t, n) for t, n in sorted(kinds.items())]
    known = df.sparkSession.createDataFrame(facts, "section string, key string, value bigint")
    counted = df.agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("shape").alias("section"), F.lit("rows").alias("key"), "value"
    )
    return counted.unionByName(known)


def column_overview(df: DataFrame) -> DataFrame:
    """(column, type, kind, present, missing) of every column, from one pass.

    ``kind`` is numeric, categorical, or other, as dates and nested values are.
    """
    kinds = dict.fromkeys(numeric_columns(df), "numeric") | dict.fromkeys(categorical_columns(df), "categorical")
    counted = df.agg(F.count(F.lit(1)).alias("rows"), F.array(*[F.count_if(missing(df, c)) for c in df.columns]).alias("gaps"))
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.lit(t).alias("type"), F.lit(kinds.get(c, "other")).alias("kind"),
            (F.col("rows") - F.col("gaps")[i]).alias("present"), F.col("gaps")[i].alias("missing"),
        )
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return counted.select(F.inline(F.array(*rows)))


def missing_counts(df: DataFrame) -> DataFrame:
    """(column, missing_count) for every column, from one pass."""
    counted = df.agg(*[F.count_if(missing(df, c)).alias(c) for c in df.columns])
    return counted.unpivot([], [F.col(quoted(c)) for c in df.columns], "column", "missing_count")


def missing_report(df: DataFrame) -> DataFrame:
    """(column, missing_count, missing_percent) for the columns that miss something."""
    total = "_rows_of_the_table"
    counted = df.agg(
        F.count(F.lit(1)).alias(total), *[F.count_if(missing(df, c)).alias(c) for c in df.columns]
    )
    return (
        counted.unpivot([total], [F.col(quoted(c)) for c in df.columns], "column", "missing_count")
        .filter(F.col("missing_count") > 0)
        .select(
            "column",
            "missing_count",
            F.round(F.col("missing_count") * 100.0 / F.col(total), 2).alias("missing_percent"),
        )
        .orderBy(F.desc("missing_count"), "column")
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier one, nulls being equal."""
    copies = df.groupBy(*[F.col(quoted(c)) for c in df.columns]).agg((F.count(F.lit(1)) - 1).alias("_extra"))
    return copies.agg(F.coalesce(F.sum("_extra"), F.lit(0)).alias("duplicate_rows"))


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """(class, count, percentage, balance_ratio), most frequent first.

    Rows without a class are not listed but stay in the denominator of the percentage.
    """
    if target not in df.columns:
        raise ValueError(f"no column {target!r} in the table")
    counts = df.groupBy(F.col(quoted(target)).alias("class")).agg(
        F.count(F.lit(1)).alias("count"), F.count(quoted(target)).alias("known")
    )
    known = F.when(F.col("known") > 0, F.col("count"))
    # The subquery is a roll-up of the same counts, so their shuffle is reused and not read twice.
    whole = counts.agg(
        F.struct(F.sum("count").alias("rows"), (F.max(known) / F.min(known)).alias("balance"))
    ).scalar()
    return (
        counts.filter(F.col("known") > 0)
        .select(
            "class",
            "count",
            F.round(F.col("count") * 100.0 / whole["rows"], 2).alias("percentage"),
            whole["balance"].alias("balance_ratio"),
        )
        .orderBy(F.desc("count"), "class")
    )


def numeric_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(feature, count, mean, std, min, q25, q50, q75, max) of the numeric columns."""
    columns = columns if columns is not None else numeric_columns(df)
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    stats = []
    for c in columns:
        value = null_if_missing(df, c).cast("double")
        stats += [
            F.count(value).alias(f"{c}:count"),
            F.avg(value).alias(f"{c}:mean"),
            F.stddev_samp(value).alias(f"{c}:std"),
            F.min(value).alias(f"{c}:min"),
            F.max(value).alias(f"{c}:max"),
        ]
    wide = df.agg(*stats)
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            *[F.col(quoted(f"{c}:{s}")).alias(s) for s in ("count", "mean", "std", "min")],
            *[F.lit(q).cast("double").alias(n) for n, q in zip(("q25", "q50", "q75"), quartiles[c])],
            F.col(quoted(f"{c}:max")).alias("max"),
        )
        for c in columns
    ]
    return wide.select(F.inline(F.array(*rows)))


def explore(df: DataFrame, target: str | None = None) -> dict[str, DataFrame]:
    """All profiling tables of one dataset, by name."""
    tables = {
        "shape": table_shape(df),
        "missing": missing_report(df),
        "duplicates": duplicate_rows(df),
        "columns": column_kinds(df),
        "statistics": numeric_summary(df),
    }
    if target is not None:
        tables["classes"] = class_distribution(df, target)
    return tables
