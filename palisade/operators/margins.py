"""Linear machines over random cosine features that are computed again in each pass and never stored.

The feature table is kept as blocks of packed columns.  A pass reads them, and several machines share it: each asks for
its loss and gradient at one point, and all points of a round are answered together.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Generator, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.schema import quoted

BLOCK_BYTES = 1 << 19  # of a block's features when they are laid out
STRIP = 512  # rows whose cosines are in a core's cache
EVERYTHING = -1  # the fold that no row is in: a machine that leaves it out sees all rows
NO_FOLD = -2


class Cosines:
    """height * cos(x @ directions + phases), in turns: whole ones are taken off before single precision is used."""

    def __init__(self, directions: np.ndarray, phases: np.ndarray):
        self.directions, self.phases = directions / (2 * math.pi), phases / (2 * math.pi)
        self.height = math.sqrt(2.0 / len(phases))

    def __call__(self, x: np.ndarray, kind: type = np.float64) -> np.ndarray:
        turns = x @ self.directions
        turns += self.phases
        turns -= np.rint(turns)
        turns = turns.astype(kind, copy=False)
        turns *= kind(2 * math.pi)
        np.cos(turns, out=turns)
        turns *= kind(self.height)
        return turns


def _packed(column: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """The values, and for each row which one it has where up to 256 of them occur."""
    values, codes = np.unique(column, return_inverse=True)
    return (values, codes.astype(np.uint8)) if len(values) <= 256 else (np.ascontiguousarray(column), None)


def feature_blocks(df: DataFrame, features: str, label: str, fold: Column, width: int) -> RDD:
    """The rows as persisted blocks (features by column, labels, folds); lost ones are packed again."""
    rows = STRIP * max(1, BLOCK_BYTES // (8 * STRIP * max(1, width)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if any(batch.column(i).null_count for i in (0, 1)):
                raise ValueError("a row without features or without a label")
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            if not np.isfinite(x).all():
                raise ValueError("features must be finite numbers")
            if not np.isin(y, (0, 1)).all():
                raise ValueError("labels must be 0 or 1")
            y, folds = y.astype(np.int8), batch.column(2).to_numpy(zero_copy_only=False).astype(np.int32)
            for at in range(0, len(x), rows):
                part = slice(at, at + rows)
                block = [_packed(column) for column in x[part].T], y[part].copy(), folds[part].copy()
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block, pickle.HIGHEST_PROTOCOL)], pa.binary())], ["block"])

    plain = df.select(
        vector_to_array(F.col(quoted(features))).alias("x"),
        F.col(quoted(label)).cast("double").alias("y"),
        F.coalesce(fold.cast("int"), F.lit(NO_FOLD)).alias("fold"),
    )
    return plain.mapInArrow(pack, "block binary").rdd.map(lambda row: bytes(row[0])).persist(StorageLevel.MEMORY_AND_DISK)


def _strips(blocks: Iterator[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for block in blocks:
        columns, y, fold = pickle.loads(block)
        x = np.empty((len(columns), len(y)))
        for row, (values, codes) in zip(x, columns):
            row[:] = values if codes is None else values[codes]
        for at in range(0, len(y), STRIP):
            part = slice(at, at + STRIP)
            yield x[:, part].T, y[part], fold[part]


def _seen(fold: np.ndarray, without: int) -> np.ndarray | None:
    """Which rows a machine trains on; None for all.  A row without a fold is in no fold's training or test."""
    return None if without == EVERYTHING else (fold != without) & (fold != NO_FOLD)


def _summed(blocks: RDD, work: Callable, size: int) -> np.ndarray:
    """``work`` gives an array per task, which are handed to the driver."""
    found = blocks.mapPartitions(lambda rows: [work(_strips(rows)).tobytes()]).collect()
    return np.array([np.frombuffer(f) for f in found]).reshape(-1, size)


def moments(blocks: RDD, cosines: Cosines, without: list[int]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each machine its rows, its positive rows, and the mean and deviation of each cosine over its rows."""
    d = len(cosines.phases)

    def joined(a: tuple, b: tuple) -> tuple:
        n = a[0] + b[0]
        if not n:
            return a
        apart = b[2] - a[2]
        return n, a[1] + b[1], a[2] + apart * (b[0] / n), a[3] + b[3] + apart**2 * (a[0] * b[0] / n)

    nothing = (0.0, 0.0, np.zeros(d), np.zeros(d))

    def work(parts) -> np.ndarray:
        found = [nothing] * len(without)
        for x, y, fold in parts:
            c = cosines(x)
            for i, f in enumerate(without):
                seen = _seen(fold, f)
                rows, labels = (c, y) if seen is None else (c[seen], y[seen])
                if len(rows):
                    mean = rows.mean(axis=0)
                    found[i] = joined(found[i], (float(len(rows)), float(labels.sum()), mean, ((rows - mean) ** 2).sum(axis=0)))
        return np.concatenate([np.concatenate(([n, p], mean, m2)) for n, p, mean, m2 in found])

    total = [nothing] * len(without)
    for task in _summed(blocks, work, len(without) * (2 + 2 * d)):
        for i, s in enumerate(task.reshape(len(without), -1)):
            total[i] = joined(total[i], (s[0], s[1], s[2 : 2 + d], s[2 + d :]))
    return [(int(n), int(p), mean, np.sqrt(m2 / max(1.0, n - 1))) for n, p, mean, m2 in total]


def hinge_sums(
    blocks: RDD, cosines: Cosines, weights: np.ndarray, intercepts: np.ndarray, without: list[int]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Summed hinge loss, and its gradient by weights and by intercept, of one machine per column of ``weights``.

    Cosines and products of a block are in single precision, sums over blocks in double.
    """
    k, d = weights.shape[1], weights.shape[0]
    w, b = np.ascontiguousarray(weights.T, np.float32), intercepts.astype(np.float32)[:, None]

    def work(parts) -> np.ndarray:
        total = np.zeros((k, d + 2))
        for x, y, fold in parts:
            c = cosines(x, np.float32)
            sign = np.where(y == 1, np.float32(1), np.float32(-1))
            short = w @ c.T
            short += b
            short *= -sign
            short += 1
            missed = short > 0
            for i, f in enumerate(without):
                seen = _seen(fold, f)
                if seen is not None:
                    missed[i] &= seen
            pull = missed * -sign
            short *= missed
            total[:, 0] += short.sum(axis=1, dtype=np.float64)
            total[:, 1] += pull.sum(axis=1, dtype=np.float64)
            total[:, 2:] += pull @ c
        return total.ravel()

    total = _summed(blocks, work, k * (d + 2)).sum(axis=0).reshape(k, d + 2)
    return total[:, 0], total[:, 2:].T, total[:, 1]


# --- the optimiser ---------------------------------------------------------------

Search = Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]


class _SearchFailed(Exception):
    pass


def _direction(grad: np.ndarray, history: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Minus the approximate inverse Hessian times the gradient; the newest step is first."""
    scale = 1.0
    if history:
        step, change = history[0]
        if not step @ change >= 0:
            raise _SearchFailed
        with np.errstate(all="ignore"):
            scale = (step @ change) / (change @ change)
    found, shares = grad.copy(), []
    with np.errstate(all="ignore"):
        for step, change in history:
            shares.append((step @ found) / (step @ change))
            if np.isnan(shares[-1]):
                raise _SearchFailed
            found -= shares[-1] * change
        found *= scale
        for (step, change), share in zip(reversed(history), reversed(shares)):
            found += step * (share - (change @ found) / (step @ change))
    return np.where(found * grad > 0, -found, 0.0)


def orthant_search(start: np.ndarray, iterations: int, tolerance: float, memory: int = 10) -> Search:
    """OWL-QN without a penalty of its own, as Spark's linear machines use it, as a generator; its steps are not theirs to the digit.

    It gives points and is sent (value, gradient) of each.  A step keeps to the orthant that it starts in; its length is
    found by backtracking until both strong Wolfe conditions hold.
    """
    x = start
    value, grad = yield x
    first, recent, history, done, failed = value, [math.inf], [], 0, False
    while done < iterations:
        if len(recent) >= 2 and abs(value - max(recent)) <= tolerance * first:
            break
        if np.linalg.norm(grad) <= max(tolerance * value, 1e-8):
            break
        try:
            way = _direction(grad, history)
            orthant = np.where(x != 0, np.sign(x), np.sign(-grad))
            slope = way @ grad
            shrink, length = (0.1, 0.5 / np.linalg.norm(grad)) if done < 1 else (0.5, 1.0)
            for attempt in range(21):
                to = x + way * length
                to = np.where(np.sign(to) == orthant, to, 0.0)
                new_value, new_grad = yield to
                new_slope = new_grad @ way
                if new_value > value + length * slope * 1e-4:
                    factor = shrink
                elif new_slope < 0.9 * slope:
                    factor = 2.1
                elif new_slope > -0.9 * slope:
                    factor = shrink
                else:
                    break
                length *= factor
                if attempt == 20 or not 1e-10 <= length <= 1e10:
                    raise _SearchFailed
        except _SearchFailed:
            if failed:
                break
            failed, history = True, []
            continue
        history = [(to - x, new_grad - grad), *history[: memory - 1]]
        x, value, grad = to, new_value, new_grad
        recent = [*recent, value][-20:]
        done, failed = done + 1, False
    return x


def fit_machines(
    blocks: RDD, cosines: Cosines, without: list[int], penalties: list[float], iterations: int, tolerance: float = 1e-6
) -> list[tuple[np.ndarray, float]]:
    """(weights, intercept) of L2-penalised hinge machines, one per fold that is left out, in shared passes.

    As Spark's do, they search over cosines of unit deviation and zero mean; the penalty is on the weights of the plain ones.
    """
    d = len(cosines.phases)
    known = moments(blocks, cosines, without)
    for fold, (rows, positives, _, _) in zip(without, known):
        if not positives:
            raise ValueError(f"no attack among the {rows} rows outside fold {fold}")
    narrow = [np.where(s > 0, 1.0 / np.where(s > 0, s, 1.0), 0.0) for _, _, _, s in known]

    def plain(i: int, x: np.ndarray) -> tuple[np.ndarray, float]:
        weights = x[:d] * narrow[i]
        return weights, float(x[d] - weights @ known[i][2])

    searches = [orthant_search(np.zeros(d + 1), iterations, tolerance) for _ in without]
    asked, found = {i: next(s) for i, s in enumerate(searches)}, {}
    while asked:
        points = [plain(i, x) for i, x in asked.items()]
        sums = hinge_sums(blocks, cosines, np.column_stack([w for w, _ in points]), np.array([b for _, b in points]), [without[i] for i in asked])
        following = {}
        for (i, x), (weights, _), loss, by_weight, by_intercept in zip(asked.items(), points, sums[0], sums[1].T, sums[2]):
            rows, _, mean, _ = known[i]
            value = loss / rows + 0.5 * penalties[i] * (weights @ weights)
            grad = np.append((by_weight - mean * by_intercept) * narrow[i] / rows + penalties[i] * weights * narrow[i], by_intercept / rows)
            try:
                following[i] = searches[i].send((value, grad))
            except StopIteration as end:
                found[i] = plain(i, end.value)
        asked = following
    return [found[i] for i in range(len(without))]


def margins_outside(spark: SparkSession, blocks: RDD, cosines: Cosines, machines: list[tuple[np.ndarray, float]]) -> DataFrame:
    """(label, margin) of every row that has a fold, by the machine that left its fold out; in double precision."""
    weights = np.column_stack([w for w, _ in machines])
    intercepts = np.array([b for _, b in machines])

    def run(rows: Iterator[bytes]) -> Iterator[tuple[list[int], list[float]]]:
        for x, y, fold in _strips(rows):
            kept = fold != NO_FOLD
            margin = np.take_along_axis(cosines(x[kept]) @ weights + intercepts, fold[kept][:, None], axis=1)[:, 0]
            yield y[kept].tolist(), margin.tolist()

    strips = spark.createDataFrame(blocks.mapPartitions(run), "labels array<int>, margins array<double>")
    pairs = F.inline(F.arrays_zip(F.col("labels").alias("label"), F.col("margins").alias("margin")))
    return strips.select(pairs)
