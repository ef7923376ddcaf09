"""Written intermediate tables, document keys and row checks shared by the operators of this package."""

from __future__ import annotations

import atexit
import contextlib
import weakref
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.session import scratch_path

#: Shuffle files of a finished write are of no more use; the settings of both generations of the name.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Batches for Python workers, where the session does not say otherwise: long texts make large rows.
_BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
KEY_BITS = 35
_live: weakref.WeakSet[Workspace] = weakref.WeakSet()


class Workspace:
    """Tables below the shared folder that belong to one run of an operator.

    A written table survives lost executors.  ``remove`` deletes one as soon as nothing reads it any
    more, ``close`` the rest; what a lazy result still reads goes when the interpreter ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_path(spark, name)
        self._count = 0
        if spark.conf.get(_BATCH[0], None) is None:
            spark.conf.set(*_BATCH)
        _live.add(self)

    def path(self, name: str) -> str:
        self._count += 1
        return f"{self.root}/{self._count:02d}-{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        before = self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(_CLEANUP)
            else:
                self.spark.conf.set(_CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.written_to = path
        return out

    def remove(self, df: DataFrame) -> None:
        delete(self.spark, df.written_to)

    def close(self) -> None:
        delete(self.spark, self.root)


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _close_all() -> None:
    for workspace in list(_live):
        with contextlib.suppress(Exception):  # the session may be gone already
            workspace.close()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh_name(df: DataFrame, wanted: str) -> str:
    """A column name that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def draw_of(seed: int, *columns: str) -> Column:
    """A number in [0, 1) that depends on the columns of a row alone; equal rows have equal ones."""
    return _hash_bits(seed, *columns) / float(1 << 40)


def _hash_bits(seed: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 40))


def hash_sample(rows: DataFrame, size: int, seed: int) -> DataFrame:
    """At least ``size`` rows, or all if there are fewer: those of the smallest hashes of id and text.

    Hashes are counted by their length in bits, so up to about twice as many rows are drawn, and more
    where rows that repeat id and text come together.
    """
    draw = _hash_bits(seed, "doc_id", "text")
    counts = dict(rows.groupBy(F.length(F.bin(draw)).alias("bits")).count().collect())  # 40 rows at most
    drawn = 0
    for bits in range(1, 40):
        drawn += counts.get(bits, 0)
        if drawn >= size:
            return rows.filter(draw < (1 << bits))
    return rows


def with_key(docs: DataFrame, workspace: Workspace, *, extra: tuple[str, ...] = ()) -> DataFrame:
    """``doc_key, doc_id, text`` (and ``extra``), where ``doc_key`` names a row and follows doc_id.

    Keys are unique, not null and lie in [0, 2**35).  Where doc_id is all that already, it is the key.
    Otherwise (nulls, repeated ids, negative or huge ids, ids of another type) the rows are sorted by doc_id (nulls first)
    and text, numbered, and written once, so that every later pass sees the same numbers.
    """
    rows = docs.select("doc_id", "text", *extra)
    seen = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("doc_id").alias("different"),
        F.min("doc_id").alias("low"),
        F.max("doc_id").alias("high"),
    ).first()
    numbers = isinstance(rows.schema["doc_id"].dataType, T.IntegralType)
    if numbers and seen.n == seen.different and (seen.n == 0 or (seen.low >= 0 and seen.high < 1 << KEY_BITS)):
        return rows.select(F.col("doc_id").cast("long").alias("doc_key"), *rows.columns)
    place = F.monotonically_increasing_id()
    placed = workspace.write(
        rows.repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", "text")
        .select(place.alias("doc_place"), *rows.columns),
        "keyed",
    )
    part = F.shiftright("doc_place", 33)
    sizes = sorted(placed.groupBy(part.alias("part")).count().collect())  # one row per partition
    before, first = {}, 0
    for p, n in sizes:
        before[p], first = first, first + n
    offsets = workspace.spark.createDataFrame(list(before.items()), "part bigint, before bigint")
    return (
        placed.join(F.broadcast(offsets), part == offsets["part"])
        .select((F.col("before") + F.col("doc_place").bitwiseAND((1 << 33) - 1)).alias("doc_key"), *rows.columns)
    )


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of one string column, a longer text alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)
