"""Quantiles from KLL sketches that are stored per part of a table and merged later.

A sketch of size k keeps a few thousand numbers of a column, however many rows it has seen.  New parts
are sketched by themselves; quantiles of any union of parts need the sketches alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.functions.cells import null_if_missing
from palisade.schema import quoted

SKETCH_SIZE = 800


def rank_error(size: int = SKETCH_SIZE) -> float:
    """By how much the rank of a returned quantile may be off, as a share of the rows, with 99 % confidence."""
    return 2.296 / size**0.9021


def column_sketches(df: DataFrame, columns: list[str], *, by: tuple[str, ...] = (), size: int = SKETCH_SIZE) -> DataFrame:
    """(by..., column, sketch): one sketch per column and part; missing cells are not counted."""
    cells = [null_if_missing(df, c).cast("double").alias(f"_c{i}") for i, c in enumerate(columns)]
    parts = df.select(*[F.col(quoted(c)) for c in by], *cells).groupBy(*[F.col(quoted(c)) for c in by])
    wide = parts.agg(*[F.kll_sketch_agg_double(f"_c{i}", size).alias(f"_s{i}") for i in range(len(columns))])
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(columns)]
    return wide.select(*[F.col(quoted(c)) for c in by], F.inline(F.array(*entries)))


def merged_sketches(sketches: DataFrame, *, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., column, sketch): the sketches of several parts as one."""
    return sketches.groupBy(*[F.col(quoted(c)) for c in by], "column").agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def sketched_quantiles(sketches: DataFrame, probabilities: list[float]) -> DataFrame:
    """All columns but the sketch, and (n, probability, value); a column without values has no rows."""
    filled = sketches.withColumn("n", F.kll_sketch_get_n_double("sketch")).filter("n > 0")
    values = [
        F.struct(F.lit(p).alias("probability"), F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias("value"))
        for p in probabilities
    ]
    return filled.select("*", F.inline(F.array(*values))).drop("sketch")


def approximate_bounds(sketches: DataFrame, multiplier: float = 1.5) -> dict[str, tuple[float, float]]:
    """Accepted range of each column by its quartiles, from one sketch per column (two numbers each)."""
    found: dict[str, dict[float, float]] = {}
    for r in sketched_quantiles(sketches, [0.25, 0.75]).collect():
        found.setdefault(r["column"], {})[r["probability"]] = r["value"]
    return {c: (q[0.25] - multiplier * (q[0.75] - q[0.25]), q[0.75] + multiplier * (q[0.75] - q[0.25])) for c, q in found.items()}
