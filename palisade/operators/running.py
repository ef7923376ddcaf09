"""Running totals over a whole ordered table without a single-task window.

A window with no partition key sends every row to one task.  Here the table is range-partitioned and
materialised once, in as many ranges as the shuffle has partitions, a window runs inside each range,
and the totals of the earlier ranges (one row per range and group) are joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.schema import quoted
from palisade.session import cut_lineage


def running_totals(
    distinct: DataFrame,
    order: str,
    sums: list[str],
    *,
    by: tuple[str, ...] = (),
    descending: bool = False,
    look_ahead: bool = False,
    totals: bool = False,
) -> DataFrame:
    """Add ``<s>_before``: the sum of ``s`` over all rows strictly earlier in the order.

    ``distinct`` holds each order value once (per ``by`` group); any value may occur, also null and the
    infinities.  ``look_ahead`` also adds ``<s>_next``, the value of ``s`` on the next row, null on the
    last one; ``totals`` adds ``<s>_total``, the sum over all rows.
    """
    keys = list(by)
    sort = F.col(quoted(order)).desc() if descending else F.col(quoted(order)).asc()
    first_row = F.max_by if descending else F.min_by

    spread = distinct.repartitionByRange(*[F.col(quoted(k)) for k in keys], sort)
    ranged = cut_lineage(spread.withColumn("_range", F.spark_partition_id()), "ranges")

    per_range = ranged.groupBy(*keys, "_range").agg(
        *[F.sum(s).alias(f"_{s}") for s in sums],
        *([first_row(s, order).alias(f"_{s}_head") for s in sums] if look_ahead else []),
    )
    over_ranges = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_range")
    earlier = over_ranges.rowsBetween(Window.unboundedPreceding, -1)
    everything = over_ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = per_range.select(
        *keys,
        "_range",
        *[F.coalesce(F.sum(f"_{s}").over(earlier), F.lit(0)).alias(f"_{s}_offset") for s in sums],
        *([F.lead(f"_{s}_head").over(over_ranges).alias(f"_{s}_head") for s in sums] if look_ahead else []),
        *([F.sum(f"_{s}").over(everything).alias(f"{s}_total") for s in sums] if totals else []),
    )

    inside = Window.partitionBy(*keys, "_range").orderBy(sort)
    inside_earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    same = [F.col(quoted(k)).eqNullSafe(F.col(f"_of_{i}")) for i, k in enumerate(keys)]
    offsets = offsets.withColumnsRenamed({k: f"_of_{i}" for i, k in enumerate(keys)} | {"_range": "_at"})
    joined = ranged.select(
        "*",
        *[F.coalesce(F.sum(s).over(inside_earlier), F.lit(0)).alias(f"_{s}_inside") for s in sums],
        *([F.lead(s).over(inside).alias(f"_{s}_lead") for s in sums] if look_ahead else []),
    ).join(offsets, [*same, F.col("_range") == F.col("_at")])
    added: list[Column] = [(F.col(f"_{s}_inside") + F.col(f"_{s}_offset")).alias(f"{s}_before") for s in sums]
    if look_ahead:
        added += [F.coalesce(f"_{s}_lead", f"_{s}_head").alias(f"{s}_next") for s in sums]
    if totals:
        added += [F.col(f"{s}_total") for s in sums]
    return joined.select(*[F.col(quoted(c)) for c in distinct.columns], *added)
