"""Voting and fusion as expressions over score columns that already exist on the row."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from palisade.config import SIGNATURE_HIT_PROBABILITY
from palisade.functions.cells import decide


def normalised_weights(n: int, weights: tuple[float, ...] | list[float] | None = None) -> list[float]:
    """Weights that sum to one; equal ones when none are given."""
    if n == 0:
        raise ValueError("an ensemble needs at least one model")
    raw = [1.0 / n] * n if not weights else [float(w) for w in weights]
    if len(raw) != n:
        raise ValueError(f"{len(raw)} weights for {n} models")
    total = sum(raw)
    if total <= 0:
        raise ValueError("weights must have a positive sum")
    return [w / total for w in raw]


def _weighted_sum(columns: list[Column], weights: list[float]) -> Column:
    return reduce(add, [c * F.lit(w) for c, w in zip(columns, weights)])


def mean_probability(p: list[Column], weights: list[float]) -> Column:
    """Weighted mean attack probability."""
    return _weighted_sum(p, weights)


def soft_vote(p: list[Column], weights: list[float]) -> Column:
    """Class with the larger mean probability; a draw is class 0."""
    normal = _weighted_sum([F.lit(1.0) - c for c in p], weights)
    return F.when(_weighted_sum(p, weights) > normal, 1).otherwise(0)


def hard_vote(predictions: list[Column], weights: list[float]) -> Column:
    """Class with the larger vote weight; a draw is class 0."""
    def votes(k: int) -> Column:
        return _weighted_sum([(c == k).cast("double") for c in predictions], weights)

    return F.when(votes(1) > votes(0), 1).otherwise(0)


def fused_probability(hit: Column, p: Column) -> Column:
    """A signature hit replaces the ensemble probability by a fixed one."""
    return F.when(hit == 1, F.lit(SIGNATURE_HIT_PROBABILITY)).otherwise(p)


def fused_label(hit: Column, p: Column, threshold: float) -> Column:
    """A signature hit is an attack at any threshold, otherwise the threshold decides."""
    return F.when(hit == 1, 1).otherwise(decide(p, threshold))
