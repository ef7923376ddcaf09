"""Session helpers: local sessions for tests, and the shared folder of a cluster."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SMALL_TABLE_ROWS = 10_000


def local_session(cpus: int | str = 8, app: str = "palisade", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_scratch: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str | None:
    """The folder every executor can reach, which the session names in ``spark.checkpoint.dir``."""
    return spark.conf.get(CHECKPOINT_CONF, None) or None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table: below the shared folder, or else in the session's warehouse.

    What lies there is removed when the interpreter ends.
    """
    base = shared_folder(spark) or spark.conf.get("spark.sql.warehouse.dir", None)
    if not base:
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    path = f"{base.rstrip('/')}/palisade/{name}-{uuid.uuid4().hex}"
    _scratch.append((spark, path))
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _remove_scratch() -> None:
    for spark, path in _scratch:
        with contextlib.suppress(Exception):  # the session may be gone already
            remove_path(spark, path)


def use_checkpoints(spark: SparkSession) -> bool:
    """Let long iterative training cut its own lineage when a shared folder is known."""
    folder = shared_folder(spark)
    if folder is None:
        return False
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return True


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Materialise a frame that several later passes read, as a table in the shared folder.

    A written table survives lost executors, and each later pass reads only the columns it needs.
    Without a shared folder the frame is persisted instead and lost blocks are recomputed.
    """
    if shared_folder(df.sparkSession) is None:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, work: Iterable[Callable]) -> list:
    """Run independent work at the same time: fits that are long rows of short jobs, tables whose last tasks leave cores idle."""
    work = list(work)
    with ThreadPoolExecutor(max(1, len(work))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(w)) for w in work]]


def on_all_cores(df: DataFrame) -> DataFrame:
    """A scan whose rows cost far more than reading them, dealt out where its files are fewer tasks than there are cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def settle_small(df: DataFrame, limit: int = SMALL_TABLE_ROWS) -> tuple[DataFrame, bool]:
    """Materialise a lookup table and tell whether it is small enough to broadcast.

    At most ``limit`` rows come to the driver.  A larger table is written instead and joins on it
    are left to shuffle.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) <= limit:
        return df.sparkSession.createDataFrame(rows, df.schema), True
    return cut_lineage(df, "lookup"), False
