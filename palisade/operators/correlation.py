"""Pairs of strongly correlated columns, for any number of columns.

The columns are cut into tiles of ``TILE``.  For every pair of tiles one pass reads those columns only; each task adds
up the centred products of its rows, batch by batch, and emits them once, cut into blocks of ``BLOCK`` by ``BLOCK``
columns.  The parts of a block meet by its key, are merged one by one, and only the pairs above the limit come out.
No task and no driver holds a matrix of all columns.  Parts are merged by the update for centred sums, so large means
cost no precision.  A pair in which a column does not vary has no correlation.  Sparse rows have a form of their own
without tiles (:func:`correlated_entries`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.schema import quoted
from palisade.session import cut_lineage

TILE, BLOCK = 1024, 128  # columns
ROWS = 2048  # at a time
_PART = "i int, j int, n bigint, height int, sums binary, products binary"
_PAIR = "first int, second int, r double"


class _Sums:
    """Count, means, centred squares and centred cross products of two sets of columns."""

    def __init__(self, n: int, a: np.ndarray, b: np.ndarray, aa: np.ndarray, bb: np.ndarray, ab: np.ndarray):
        self.n, self.a, self.b, self.aa, self.bb, self.ab = n, a, b, aa, bb, ab

    @classmethod
    def of(cls, left: np.ndarray, right: np.ndarray) -> _Sums:
        a, b = left.mean(axis=0), right.mean(axis=0)
        left, right = left - a, right - b
        return cls(len(left), a, b, (left * left).sum(axis=0), (right * right).sum(axis=0), left.T @ right)

    def merge(self, other: _Sums) -> _Sums:
        n = self.n + other.n
        weight, share = self.n * other.n / n, other.n / n
        a, b = other.a - self.a, other.b - self.b
        self.aa += other.aa + weight * a * a
        self.bb += other.bb + weight * b * b
        self.ab += other.ab + weight * np.outer(a, b)
        self.a, self.b, self.n = self.a + share * a, self.b + share * b, n
        return self

    def block(self, rows: slice, columns: slice) -> tuple[bytes, bytes]:
        sums = np.concatenate([self.a[rows], self.aa[rows], self.b[columns], self.bb[columns]])
        return sums.tobytes(), self.ab[rows, columns].tobytes()

    @classmethod
    def read(cls, n: int, sums: bytes, products: bytes, height: int) -> _Sums:
        flat = np.frombuffer(sums).copy()
        width = len(flat) // 2 - height
        a, aa, b, bb = np.split(flat, np.cumsum([height, height, width]))
        return cls(n, a, b, aa, bb, np.frombuffer(products).reshape(height, width).copy())


def _partial_sums(load: Callable[[pa.RecordBatch, range], np.ndarray], left: range, right: range):
    """Parts of all blocks of a pair of tiles, once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                x = load(rows, left)
                y = x if left == right else load(rows, right)
                part = _Sums.of(x, y)
                total = part if total is None else total.merge(part)
        if total is None:
            return
        for i in range(0, len(left), BLOCK):
            for j in range(0, len(right), BLOCK):
                if left.start + i <= right.start + j:
                    sums, products = total.block(slice(i, i + BLOCK), slice(j, j + BLOCK))
                    key = [pa.array([left.start + i], pa.int32()), pa.array([right.start + j], pa.int32())]
                    size = [pa.array([total.n], pa.int64()), pa.array([len(total.a[i : i + BLOCK])], pa.int32())]
                    values = [pa.array([sums], pa.binary()), pa.array([products], pa.binary())]
                    yield pa.RecordBatch.from_arrays(key + size + values, ["i", "j", "n", "height", "sums", "products"])

    return run


def _strong_pairs(limit: float):
    """Merge the parts of each block, which come one after the other, and give its pairs above the limit."""

    def pairs(i: int, j: int, total: _Sums) -> pa.RecordBatch:
        with np.errstate(divide="ignore", invalid="ignore"):
            r = total.ab / np.sqrt(np.outer(total.aa, total.bb))
        a, b = np.nonzero(np.abs(r) > limit)  # a comparison with NaN is false
        a, b = a[(ahead := i + a < j + b)], b[ahead]
        return pa.RecordBatch.from_arrays([pa.array(i + a, pa.int32()), pa.array(j + b, pa.int32()), pa.array(r[a, b], pa.float64())], ["first", "second", "r"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            for row in batch.to_pylist():
                key = row["i"], row["j"]
                part = _Sums.read(row["n"], row["sums"], row["products"], row["height"])
                if key != at:
                    if at is not None:
                        yield pairs(*at, total)
                    at, total = key, part
                else:
                    total = total.merge(part)
        if at is not None:
            yield pairs(*at, total)

    return run


def _all_pairs(tile: Callable[[range, range], tuple[DataFrame, Callable]], size: int, limit: float) -> DataFrame:
    tiles = [range(at, min(at + TILE, size)) for at in range(0, size, TILE)]
    parts = []
    for i, left in enumerate(tiles):
        for right in tiles[i:]:
            table, load = tile(left, right)
            parts.append(table.mapInArrow(_partial_sums(load, left, right), _PART))
    met = reduce(DataFrame.unionByName, parts).repartition("i", "j").sortWithinPartitions("i", "j")
    return met.mapInArrow(_strong_pairs(limit), _PAIR)


def correlated_columns(df: DataFrame, columns: list[str], limit: float) -> DataFrame:
    """``(first, second, r)``: positions of two columns, the first before the second, with a Pearson |r| above the limit.

    The columns must be numeric and without missing cells.
    """

    def load(batch: pa.RecordBatch, span: range) -> np.ndarray:
        return np.column_stack([batch.column(f"_{k}").to_numpy(zero_copy_only=False) for k in span])

    def tile(left: range, right: range) -> tuple[DataFrame, Callable]:
        wanted = sorted({*left, *right})
        return df.select(*[F.col(quoted(columns[k])).cast("double").alias(f"_{k}") for k in wanted]), load

    return _all_pairs(tile, len(columns), limit)


def correlated_entries(df: DataFrame, size: int, entries: str, limit: float) -> DataFrame:
    """The same for sparse rows: an array of structs ``(index, value)`` per row, cells without an entry being zero.

    Entries are multiplied with those of their own row only, so the work grows with the pairs of a row's entries and
    not with the square of ``size``.  Columns that share no row have r = -u v, where u and v are numbers of one column
    each; the pairs above the limit are among the columns whose u reaches it with the largest u of all.
    """
    rows = cut_lineage(df.select(F.col(entries).alias("_entries")), "entries")
    n = rows.count()
    k, mean, cells = F.col("k"), F.col("mean"), rows.select(F.inline("_entries"))
    columns = cells.groupBy("index").agg(F.count(F.lit(1)).alias("k"), F.avg("value").alias("mean"), F.var_pop("value").alias("spread"))
    columns = cut_lineage(columns, "columns")
    # A column without an empty cell is shifted by its mean, as a large one would cost precision; a row has an entry of each.
    full = {r["index"]: r["mean"] for r in columns.filter(k == n).select("index", "mean").collect()}

    def shifted(e: Column) -> Column:
        value = e["value"]
        for i, by in full.items():
            value = F.when(e["index"] == i, e["value"] - by).otherwise(value)
        return F.struct(e["index"].alias("index"), value.alias("value"))

    total = F.when(k == n, 0.0).otherwise(k * mean).alias("total")
    squares = (k * F.col("spread") + k * ((n - k) / F.lit(float(n))) * mean * mean).alias("squares")  # about the mean
    columns = columns.select("index", total, squares).filter("squares > 0")
    columns = cut_lineage(columns.withColumn("u", F.abs("total") / F.sqrt(F.col("squares") * n)), "varying")
    largest = columns.agg(F.max("u")).first()[0] or 0.0
    reaching = columns.filter(F.col("u") * largest > limit * (1 - 1e-9))

    def side(of: DataFrame, name: str) -> DataFrame:
        return of.select(*[F.col(c).alias(f"{name}_{c}") for c in columns.columns])

    pairs = (
        rows.select(F.transform("_entries", shifted).alias("_entries"))
        .select("_entries", F.inline("_entries"))
        .select(F.col("index").alias("first"), F.col("value").alias("x"), F.inline("_entries"))
        .filter(F.col("first") < F.col("index"))
        .groupBy("first", F.col("index").alias("second"))
        .agg(F.sum(F.col("x") * F.col("value")).alias("product"))
    )
    pairs = cut_lineage(pairs, "pairs")
    met = pairs.join(side(columns, "a"), F.col("first") == F.col("a_index")).join(side(columns, "b"), F.col("second") == F.col("b_index"))
    apart = side(reaching, "a").join(side(reaching, "b"), (F.col("a_index") < F.col("b_index")) & (F.col("a_u") * F.col("b_u") > limit * (1 - 1e-9)))
    apart = apart.join(pairs, (F.col("a_index") == F.col("first")) & (F.col("b_index") == F.col("second")), "left_anti").withColumn("product", F.lit(0.0))
    products = (F.col("product") - F.col("a_total") * F.col("b_total") / F.lit(float(n))).alias("centred")
    found = [x.select(F.col("a_index").alias("first"), F.col("b_index").alias("second"), "a_squares", "b_squares", products) for x in (met, apart)]
    r = F.col("centred") / (F.sqrt("a_squares") * F.sqrt("b_squares"))
    return found[0].unionByName(found[1]).select("first", "second", r.alias("r")).filter(F.abs("r") > limit)
