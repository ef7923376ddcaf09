"""Hard negatives of anchors by exact integer inner products, many candidates in one multiplication.

Components become whole numbers, ``floor(SCALE * x)``.  A slab of candidates is packed, component by component,
into wide integers (Kronecker substitution): every candidate lies in a field of its own, biased so that it is not
negative, and a field is wide enough for the largest inner product.  An anchor then needs one multiplication for
each of its components, whatever the number of fields; the fields of the sum are the biased inner products of all
the candidates, exactly.

Where two or more fields fit into 64 bits, the wide integers are 64 bits long and all anchors of a block are
multiplied together; otherwise they hold ``SLAB`` candidates each and are as long as that needs.

Anchors are a stated set of queries that meets all rows in blocks: rows are dealt to blocks of about ``ROWS``,
anchors to blocks of about ``ANCHORS``, and every pair of blocks is one group of a cogrouped map.  A first pass
finds an anchor's positives, which set the bounds for its negatives; a second pass finds those.  A group only
returns the best few of its rows for each anchor, so results are merged from a few rows per anchor and block.

Rows with a null label, a null vector, or a null or non-finite component take no part.  Vectors that are shorter
than others count as continued by zeros, an empty one as all zeros.  A null id sorts before all others.  Rows that
share an id are separate rows, each an anchor, positive or negative of its own; ties between them have equal
results.  An empty table, or one without anchors, gives no rows.  Other columns are ignored.  Scores must fit into
64 bits; otherwise the query fails.
"""

from __future__ import annotations

from collections.abc import Callable
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.llm.tables import Workspace

SCALE = 256
ROWS, ANCHORS = 8_192, 512  # of a block
SLAB = 1_024  # candidates in an integer of more than 64 bits


def whole_vectors(vectors: DataFrame, anchor: Column) -> DataFrame:
    """``row, vec_id, label, anchor, parts`` of the rows that take part."""
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.transform("embedding", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("long")).alias("parts"),
    )


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """One row per vector, shorter ones continued by zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy()
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def field_bits(low: int, high: int, width: int) -> int:
    """Bits of a field that holds any sum of ``width`` products of numbers in [0, high - low]."""
    return max(1, (width * (high - low) ** 2).bit_length())


def _by_words(lifted: np.ndarray, rows: np.ndarray, bits: int) -> np.ndarray:
    """Inner products of numbers that are not negative, 64 // bits candidates in each 64-bit integer."""
    fields = 64 // bits
    long = -(-len(rows) // fields)
    packed = np.zeros((long, rows.shape[1]), np.uint64)
    for f in range(fields):
        part = rows[f * long : (f + 1) * long].astype(np.uint64)
        packed[: len(part)] += part << np.uint64(f * bits)
    sums = lifted.astype(np.uint64) @ packed.T  # one multiplication and addition for each component of an anchor
    mask = np.uint64((1 << bits) - 1)
    out = np.empty((len(lifted), fields * long), np.int64)
    for f in range(fields):
        out[:, f * long : (f + 1) * long] = sums >> np.uint64(f * bits) & mask
    return out[:, : len(rows)]


def _by_wide_integers(lifted: np.ndarray, rows: np.ndarray, bits: int) -> np.ndarray:
    """The same for fields that leave no room for a second one in 64 bits: a slab of candidates in each integer."""
    size = -(-bits // 8)
    out = np.empty((len(lifted), len(rows)), object)
    for at in range(0, len(rows), SLAB):
        slab = rows[at : at + SLAB]
        packed = [int.from_bytes(b"".join(int(x).to_bytes(size, "little") for x in column), "little") for column in slab.T]
        for i, anchor in enumerate(lifted):
            raw = sum(map(mul, map(int, anchor), packed)).to_bytes(len(slab) * size, "little")
            out[i, at : at + SLAB] = [int.from_bytes(raw[k : k + size], "little") for k in range(0, len(raw), size)]
    return out


def inner_products(anchors: np.ndarray, rows: np.ndarray, low: int, high: int) -> np.ndarray:
    """Scores of anchors (first axis) and rows, for components that lie in [low, high]."""
    bits, width = field_bits(low, high, rows.shape[1]), rows.shape[1]
    narrow = bits <= 32
    if not narrow:
        anchors, rows = anchors.astype(object), rows.astype(object)
    lifted = (_by_words if narrow else _by_wide_integers)(anchors - low, rows - low, bits)
    # sum (a - low)(x - low) = sum a x - low sum a - low sum x + width low^2
    out = lifted
    out += low * rows.sum(axis=1)
    out += (low * anchors.sum(axis=1) - width * low * low)[:, None]
    return out if narrow else np.array([[int(x) for x in line] for line in out], np.int64).reshape(out.shape)


class _Block:
    """The rows of a block as arrays; ``best`` picks by score, then id."""

    def __init__(self, table: pa.Table, width: int):
        self.row = table.column("row").to_numpy()
        self.label = table.column("label").to_numpy()
        self.parts = _matrix(table.column("parts"), width)
        self.ids = table.column("vec_id").combine_chunks()
        known = np.asarray(self.ids.is_valid())
        order = np.lexsort((self.row, np.asarray(self.ids.fill_null(0)), known))
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))

    def best(self, at: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
        if len(at) > n:
            least = np.partition(score[at], len(at) - n)[len(at) - n]
            at = at[score[at] >= least]
        return at[np.lexsort((self.place[at], -score[at]))[:n]]


_POSITIVES = "anchor_row bigint, anchor_id bigint, positive_row bigint, positive_id bigint, positive_score bigint"
_NEGATIVES = f"{_POSITIVES}, negative_row bigint, negative_id bigint, negative_score bigint"


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


def _met(anchors: DataFrame, rows: DataFrame, shape: tuple[int, int], fn: Callable, ddl: str) -> DataFrame:
    """``fn`` for every pair of a block of anchors and a block of rows."""
    across, down = shape
    deal = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = [F.col(c).alias(c) for c in anchors.columns]  # both sides may come from one table
    left = anchors.select(*own, deal(across).alias("across"), every(down).alias("down"))
    right = rows.select("*", deal(down).alias("down"), every(across).alias("across"))
    return left.groupBy("across", "down").cogroup(right.groupBy("across", "down")).applyInArrow(fn, ddl)


def _top(found: DataFrame, group: list[str], score: str, who: str, row: str, n: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc(score), F.asc_nulls_first(who), row)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def hard_negatives(
    vectors: DataFrame,
    workspace: Workspace,
    anchor: Column,
    *,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``vec_id, label, embedding``.  An anchor's positives are its best other rows of its label; the
    negatives of a positive are the best rows of other labels whose score lies within ``window``, in hundredths of
    the positive's score.
    """
    low_share, high_share = window
    rows = workspace.write(whole_vectors(vectors, anchor), "vectors")
    seen = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("anchor").alias("anchors"), F.max(F.size("parts")).alias("width"),
        F.min(F.array_min("parts")).alias("low"), F.max(F.array_max("parts")).alias("high"),
    ).first()
    low, high, width = min(seen.low or 0, 0), max(seen.high or 0, 0), max(seen.width or 0, 1)
    shape = max(1, -(-seen.anchors // ANCHORS)), max(1, -(-seen.rows // ROWS))
    anchors, rows = rows.filter("anchor").drop("anchor"), rows.drop("anchor")

    def positive(a: pa.Table, b: pa.Table) -> pa.Table:
        out = {c: [] for c in _names(_POSITIVES)}
        if a.num_rows and b.num_rows:
            left, right = _Block(a, width), _Block(b, width)
            for i, score in enumerate(inner_products(left.parts, right.parts, low, high)):
                same = np.flatnonzero((right.label == left.label[i]) & (right.row != left.row[i]))
                for j in right.best(same, score, positives):
                    for c, x in zip(out, (left.row[i], left.ids[i].as_py(), right.row[j], right.ids[j].as_py(), score[j]), strict=True):
                        out[c].append(x)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    found = _met(anchors, rows, shape, positive, _POSITIVES)
    best = _top(found, ["anchor_row"], "positive_score", "positive_id", "positive_row", positives)
    best = best.groupBy("anchor_row").agg(F.collect_list(F.struct("positive_row", "positive_id", "positive_score")).alias("positives"))
    with_positives = workspace.write(anchors.join(best, F.col("row") == F.col("anchor_row")).drop("anchor_row"), "positives")

    def negative(a: pa.Table, b: pa.Table) -> pa.Table:
        out = {c: [] for c in _names(_NEGATIVES)}
        if a.num_rows and b.num_rows:
            left, right = _Block(a, width), _Block(b, width)
            of = a.column("positives").to_pylist()
            for i, score in enumerate(inner_products(left.parts, right.parts, low, high)):
                other = np.flatnonzero(right.label != left.label[i])
                their = score[other]
                for p in of[i]:
                    # 100 s >= low p and 100 s <= high p, without leaving 64 bits
                    least, most = -(-low_share * p["positive_score"] // 100), high_share * p["positive_score"] // 100
                    if least <= most:
                        for j in right.best(other[(their >= least) & (their <= most)], score, negatives):
                            for c, x in zip(out, (left.row[i], left.ids[i].as_py(), *p.values(), right.row[j], right.ids[j].as_py(), score[j]), strict=True):
                                out[c].append(x)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    found = _met(with_positives, rows, shape, negative, _NEGATIVES)
    best = _top(found, ["anchor_row", "positive_row"], "negative_score", "negative_id", "negative_row", negatives)
    return best.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def moved_labels(vectors: DataFrame) -> DataFrame:
    """The label of every seventh id moved on by one: rows whose label does not tell their neighbourhood."""
    moved = (F.col("label").cast("long") + 1) % 10
    return vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, moved).otherwise(F.col("label").cast("long")))


def negatives_digest(vectors: DataFrame, workspace: Workspace) -> DataFrame:
    return hard_negatives(moved_labels(vectors.select("vec_id", "label", "embedding")), workspace, F.col("vec_id") % 50 == 0)


NEGATIVES_SQL = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS parts
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.parts, b.parts) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 3
"""
