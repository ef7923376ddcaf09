"""Exact quantiles whose memory stays bounded however many distinct values a column has.

While a column has few rows or few distinct values, its values are counted (map-side combined)
and the wanted ranks are read off the running counts.  Otherwise the wanted order statistics are
bracketed with the mergeable approximate percentile, the rows around the bracket are counted, and
the bracket is narrowed until an endpoint is the answer or few enough rows are left to count.
Every narrowing round is two aggregations over the table for all columns together: no sort and no
wide shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.functions.cells import null_if_missing
from palisade.schema import quoted

VALUE_LIMIT = 1_000_000
ACCURACY = 10_000


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    *,
    discrete: bool = False,
    value_limit: int = VALUE_LIMIT,
    accuracy: int = ACCURACY,
) -> dict[str, list[float | None]]:
    """Quantiles of each column over its non-missing values, ``None`` for an empty column.

    ``discrete=False`` interpolates linearly between neighbours, ``discrete=True`` returns the
    smallest stored value whose cumulative share reaches the probability.
    """
    if not columns:
        return {}
    values = df.select(*[null_if_missing(df, c).cast("double").alias(c) for c in columns])
    seen = values.agg(
        *[F.count(F.col(quoted(c))).alias(f"n:{c}") for c in columns],
        *[F.approx_count_distinct(F.col(quoted(c))).alias(f"d:{c}") for c in columns],
    ).first()
    counts = {c: seen[f"n:{c}"] for c in columns}
    wanted = {c: [_ranks(p, counts[c], discrete) for p in probabilities] for c in columns if counts[c]}
    targets = {
        (c, rank): _Target(c, rank, counts[c]) for c, picks in wanted.items() for pick in picks for rank in pick[:2]
    }

    while True:
        wide = [
            t
            for t in targets.values()
            if t.value is None and t.inside > value_limit and (t.narrowed or seen[f"d:{t.column}"] > value_limit)
        ]
        if not wide:
            break
        _narrow(values, wide, accuracy)
    _count_values(values, [t for t in targets.values() if t.value is None])

    answer: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    for c, picks in wanted.items():
        for i, (low, high, share) in enumerate(picks):
            a, b = targets[c, low].value, targets[c, high].value
            answer[c][i] = a if a == b else (1.0 - share) * a + share * b
    return answer


def _ranks(p: float, n: int, discrete: bool) -> tuple[int, int, float]:
    """The two neighbouring ranks (from 0) of a quantile and the weight of the upper one."""
    if discrete:
        r = max(math.ceil(p * n) - 1, 0)
        return r, r, 0.0
    position = p * (n - 1)
    low = math.floor(position)
    return low, min(math.ceil(position), n - 1), position - low


class _Target:
    """The value at one rank of a column, known to lie strictly between ``low`` and ``high``.

    ``None`` is no bound; infinities are ordinary values.
    """

    def __init__(self, column: str, rank: int, n: int):
        self.column, self.rank = column, rank
        self.low: float | None = None
        self.high: float | None = None
        self.below, self.inside = 0, n
        self.value: float | None = None

    @property
    def narrowed(self) -> bool:
        return self.low is not None or self.high is not None

    def inside_or_null(self) -> Column:
        c = F.col(quoted(self.column))
        keep = c.isNotNull()
        if self.low is not None:
            keep = keep & (c > F.lit(self.low))
        if self.high is not None:
            keep = keep & (c < F.lit(self.high))
        return F.when(keep, c)


def _count_values(values: DataFrame, targets: list[_Target]) -> None:
    """Read the targets off the running counts of the values inside their brackets."""
    if not targets:
        return
    brackets = list(dict.fromkeys((t.column, t.low, t.high) for t in targets))
    of_bracket = {b: [t for t in targets if (t.column, t.low, t.high) == b] for b in brackets}
    entries = [
        F.struct(F.lit(i).alias("bracket"), of_bracket[b][0].inside_or_null().alias("value"))
        for i, b in enumerate(brackets)
    ]
    counted = (
        values.select(F.inline(F.array(*entries)))
        .filter(F.col("value").isNotNull())
        .groupBy("bracket", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = F.sum("n").over(Window.partitionBy("bracket").orderBy("value"))
    ranks = F.array(
        *[F.array(*[F.lit(t.rank - t.below).cast("bigint") for t in of_bracket[b]]) for b in brackets]
    )
    here = F.filter(
        F.element_at(ranks, F.col("bracket") + 1),
        lambda r: (r >= F.col("upto") - F.col("n")) & (r < F.col("upto")),
    )
    found = (
        counted.withColumn("upto", upto).select("bracket", "value", F.explode(here).alias("rank")).collect()
    )  # one row per target
    value = {(r["bracket"], r["rank"]): r["value"] for r in found}
    for i, b in enumerate(brackets):
        for t in of_bracket[b]:
            t.value = value[i, t.rank - t.below]


def _narrow(values: DataFrame, targets: list[_Target], accuracy: int) -> None:
    """One narrowing round: approximate endpoints, then exact counts around them."""
    margin = 2.0 / accuracy
    exprs = []
    for i, t in enumerate(targets):
        share = (t.rank - t.below + 0.5) / t.inside
        ends = [max(share - margin, 0.0), min(share + margin, 1.0)]
        exprs.append(F.percentile_approx(t.inside_or_null(), ends, accuracy).alias(f"b{i}"))
    ends_row = values.agg(*exprs).first()

    exprs = []
    for i, t in enumerate(targets):
        low, high = ends_row[i]
        c = t.inside_or_null()
        exprs += [
            F.count_if(c < low).alias(f"before{i}"),
            F.count_if(c == low).alias(f"low{i}"),
            F.count_if((c > low) & (c < high)).alias(f"mid{i}"),
            F.count_if(c == high).alias(f"high{i}"),
        ]
    found = values.agg(*exprs).first().asDict()
    for i, t in enumerate(targets):
        low, high = ends_row[i]
        before, at_low, mid, at_high = (found[f"{k}{i}"] for k in ("before", "low", "mid", "high"))
        if low == high:
            at_high = 0
        local = t.rank - t.below
        if local < before:  # the approximation overshot: keep the part below it
            t.high, t.inside = low, before
        elif local < before + at_low:
            t.value = low
        elif local < before + at_low + mid:
            t.below, t.low, t.high, t.inside = t.below + before + at_low, low, high, mid
        elif local < before + at_low + mid + at_high:
            t.value = high
        else:
            skipped = before + at_low + mid + at_high
            t.below, t.low, t.inside = t.below + skipped, high, t.inside - skipped
