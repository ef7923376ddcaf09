"""One-hot encoding as sparse vectors, for any number of categories.

The categories are a dictionary table ``(place, column, value, index)`` that is written once and joined; no category
becomes a column, an expression or a number on the driver.  Categories are sorted within their column, all are kept,
and columns follow each other, so the indices of all columns form one range.  Missing and unseen values have no
index: they are all zeros.  Numeric columns can lead the vector.  :func:`palisade.operators.encoding.indicators` is
the form with one named column per category, for few of them.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.operators.fitted import HasState
from palisade.schema import quoted
from palisade.session import cut_lineage, scratch_path

DICTIONARY_SCHEMA = "place int, column string, value string, index bigint"


def category_dictionary(df: DataFrame, columns: list[str]) -> DataFrame:
    """``DICTIONARY_SCHEMA``: the distinct values of each column, numbered without gaps in sorted order.

    The values are range-partitioned, numbered inside each range, and moved on by the rows of the ranges before.
    """
    cells = [F.struct(F.lit(i).alias("place"), F.lit(c).alias("column"), F.col(quoted(c)).cast("string").alias("value")) for i, c in enumerate(columns)]
    distinct = df.select(F.inline(F.array(*cells))).filter(F.col("value").isNotNull()).distinct()
    ranged = cut_lineage(distinct.repartitionByRange("place", "value").withColumn("_range", F.spark_partition_id()), "categories")
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (  # one row per range
        ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
        .select(F.col("_range").alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = F.row_number().over(Window.partitionBy("_range").orderBy("place", "value"))
    numbered = ranged.withColumn("_inside", inside).join(offsets, F.col("_range") == F.col("_at"))
    return numbered.select("place", "column", "value", (F.col("_offset") + F.col("_inside") - 1).alias("index"))


def with_sparse_entries(
    df: DataFrame, dictionary: DataFrame, columns: list[str], numeric: list[str] | tuple[str, ...] = (), output: str = "entries"
) -> DataFrame:
    """Add an array of structs ``(index, value)``, by index: numeric cells that are not zero, then categories.

    One equi-join per column; the dictionary's part for a column is broadcast only where Spark finds it small, and
    a frequent value's rows are split by the adaptive plan otherwise.
    """
    first, names = len(numeric), df.columns
    cells = [
        F.when(F.col(quoted(c)) != 0, F.struct(F.lit(i).cast("int").alias("index"), F.col(quoted(c)).cast("double").alias("value")))
        for i, c in enumerate(numeric)
    ]
    for place, c in enumerate(columns):
        of_column = dictionary.filter(F.col("place") == place).select(F.col("value").alias(f"_value{place}"), F.col("index").alias(f"_index{place}"))
        df = df.join(of_column, F.col(quoted(c)).cast("string") == F.col(f"_value{place}"), "left").drop(f"_value{place}")
        index = F.col(f"_index{place}")
        cells.append(F.when(index.isNotNull(), F.struct((index + first).cast("int").alias("index"), F.lit(1.0).alias("value"))))
    entries = F.filter(F.array(*cells), lambda e: e.isNotNull())
    return df.select(*[F.col(quoted(c)) for c in names], entries.alias(output))


def sparse_vectors(df: DataFrame, size: int, entries: str, output: str = "features") -> DataFrame:
    """Replace the entries by a vector column for ``pyspark.ml``.

    The columns of a sparse vector are laid out by expressions; the map over Arrow batches only gives them the type.
    """
    kept = [c for c in df.columns if c != entries]
    laid_out = F.struct(
        F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"),
        F.col(f"{entries}.index").alias("indices"), F.col(f"{entries}.value").alias("values"),
    )
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(output, VectorUDT())])
    return df.select(*[F.col(quoted(c)) for c in kept], laid_out.alias(output)).mapInArrow(lambda batches: batches, schema)


class SparseOneHot(Estimator, HasState):
    """Learns the dictionary of the categorical columns and writes it to ``path``, or to the shared folder."""

    def __init__(self, columns: list[str] | None = None, numeric: list[str] | None = None, path: str | None = None, output: str = "features"):
        super().__init__()
        self.with_state({"columns": list(columns or ()), "numeric": list(numeric or ()), "path": path, "output": output})

    def _fit(self, dataset: DataFrame) -> SparseOneHotModel:
        s = self.learned
        path = s["path"] or scratch_path(dataset.sparkSession, "dictionary")
        category_dictionary(dataset, s["columns"]).write.mode("overwrite").parquet(path)
        size = dataset.sparkSession.read.parquet(path).count() + len(s["numeric"])
        return SparseOneHotModel().with_state({**s, "path": path, "size": size})


class SparseOneHotModel(Model, HasState):
    """Adds a sparse vector of the numeric columns and the indicators of the categorical ones."""

    @property
    def size(self) -> int:
        return self.learned["size"]

    def dictionary(self, spark) -> DataFrame:
        return spark.read.schema(DICTIONARY_SCHEMA).parquet(self.learned["path"])

    def entries(self, df: DataFrame, output: str = "entries") -> DataFrame:
        s = self.learned
        return with_sparse_entries(df, self.dictionary(df.sparkSession), s["columns"], s["numeric"], output)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return sparse_vectors(self.entries(dataset, "_entries"), self.size, "_entries", self.learned["output"])
