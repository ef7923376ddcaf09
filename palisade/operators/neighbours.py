"""Mutual information of a class and a continuous column, from distances to nearest neighbours.

Ross (2014), "Mutual Information between Discrete and Continuous Data Sets": each row's distance to the
k-th nearest row of its class is compared with the number of rows of any class that are closer.  In one
dimension the neighbours of a row are those beside it in sorted order.  Rows of equal value and class are
counted once with a weight; the rest is range-partitioned running totals and blocks of ``BLOCK`` values of
a class that take the k values beyond their borders along, so no class or column goes through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.functions.cells import null_if_missing
from palisade.operators.running import running_totals
from palisade.schema import quoted
from palisade.session import cut_lineage

NEIGHBOURS = 3
BLOCK = 8192


def digamma(n: Column) -> Column:
    """Of a count: six steps of the recurrence, then the asymptotic series (error below 1e-9)."""
    z = n.cast("double") + 6
    inverse = 1 / (z * z)
    series = inverse * (F.lit(1 / 12) - inverse * (F.lit(1 / 120) - inverse * (F.lit(1 / 252) - inverse / 240)))
    return F.log(z) - 0.5 / z - series - sum((1 / (n.cast("double") + i) for i in range(6)), F.lit(0.0))


def _weighted_values(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """``feature, y, x, n, of_class``: the different values of each class that has at least two rows."""
    numbers = [null_if_missing(df, c).cast("double") for c in features]
    entries = [F.struct(F.lit(i).alias("feature"), x.alias("x")) for i, x in enumerate(numbers)]
    cells = (
        df.select(F.col(quoted(label)).alias("y"), F.inline(F.array(*entries)))
        .filter(F.col("y").isNotNull() & (F.abs("x") < float("inf")))
        .groupBy("feature", "y", "x")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    cells = cut_lineage(cells, "values")
    sizes = cells.groupBy(F.col("feature").alias("f"), F.col("y").alias("of")).agg(F.sum("n").alias("of_class"))
    same = (F.col("feature") == F.col("f")) & (F.col("y") == F.col("of"))
    return cells.join(sizes.filter("of_class > 1"), same).select("feature", "y", "x", "n", "of_class")


def _with_radius(cells: DataFrame, k: int, block: int) -> DataFrame:
    """Add ``k``, the neighbours there are (k at most), and ``r``, the distance to the last of them."""
    ranked = running_totals(cells.withColumn("one", F.lit(1)), "x", ["one"], by=("feature", "y"))
    home, place = F.floor(F.col("one_before") / block), F.col("one_before") % block
    guests = F.array(home, F.when(place < k, home - 1), F.when(place >= block - k, home + 1))
    spread = ranked.select("*", home.alias("home"), F.explode(F.array_compact(guests)).alias("block"))
    beside = Window.partitionBy("feature", "y", "block").orderBy("x")

    def distances(step: int) -> Column:
        x, n = F.lag("x", step).over(beside), F.lag("n", step).over(beside)
        return F.array_repeat(F.abs(F.col("x") - x), F.when(n.isNull(), 0).otherwise(F.least(n, F.lit(k))).cast("int"))

    steps = [s for i in range(1, k + 1) for s in (i, -i)]
    own = F.array_repeat(F.lit(0.0), F.least(F.col("n") - 1, F.lit(k)).cast("int"))
    met = spread.withColumn("near", F.sort_array(F.concat(own, *map(distances, steps)))).filter("block = home")
    found = F.least(F.col("of_class") - 1, F.lit(k)).cast("int")
    return met.select("feature", "x", "n", "of_class", found.alias("k"), F.element_at("near", found).alias("r"))


def neighbour_information(df: DataFrame, features: list[str], label: str, k: int = NEIGHBOURS, block: int = BLOCK) -> DataFrame:
    """(feature, score): the estimate in nats, at least 0.

    Rows without a class, missing and infinite cells, and classes of one row take no part; a column without
    any others scores 0.  Ties: a row counts the rows of any class whose value lies strictly between x - r
    and x + r, itself included; where r is 0, the rows of its own value.
    """
    if block < 2 * k:
        raise ValueError("a block has to hold the neighbours of both sides")
    cells = cut_lineage(_with_radius(cut_lineage(_weighted_values(df, features, label), "cells"), k, block), "radius")
    low, high = F.col("x") - F.col("r"), F.col("x") + F.col("r")
    points = cells.select("feature", F.col("x").alias("v"), "n")
    ends = cells.filter("r > 0").select("feature", F.explode(F.array(low, high)).alias("v"), F.lit(0).cast("bigint").alias("n"))
    marks = points.unionByName(ends).groupBy("feature", "v").agg(F.sum("n").alias("n"))
    marks = cut_lineage(running_totals(marks, "v", ["n"], by=("feature",)), "marks")
    below = marks.select(F.col("feature").alias("f"), F.col("v").alias("high"), F.col("n").alias("here"), F.col("n_before").alias("before"))
    upto = marks.select(F.col("feature").alias("g"), F.col("v").alias("low"), (F.col("n") + F.col("n_before")).alias("upto"))
    met = cells.join(below, (F.col("feature") == F.col("f")) & (high == F.col("high")))
    met = met.join(upto, (F.col("feature") == F.col("g")) & (low == F.col("low")))
    closer = F.when(F.col("r") == 0, F.col("here")).otherwise(F.greatest(F.col("before") - F.col("upto"), F.col("n")))
    gain = digamma(F.col("k")) - digamma(F.col("of_class")) - digamma(closer)
    scores = met.groupBy("feature").agg(F.sum("n").alias("rows"), F.sum(F.col("n") * gain).alias("gain"))
    names = df.sparkSession.createDataFrame(list(enumerate(features)), "of int, name string")
    score = F.greatest(digamma(F.col("rows")) + F.col("gain") / F.col("rows"), F.lit(0.0))
    joined = names.join(scores, F.col("of") == F.col("feature"), "left")
    return joined.select(F.col("name").alias("feature"), F.coalesce(score, F.lit(0.0)).alias("score"))
