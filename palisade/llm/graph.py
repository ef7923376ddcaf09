"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.llm.tables import Workspace

LINKS_PER_TASK = 500_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one task, replaced by one link from each node to the smallest it reaches here."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], ["a", "b"])


def components(links: DataFrame, workspace: Workspace) -> DataFrame:
    """``node, component`` of every node of links ``a, b`` (longs), component its smallest node.

    Tasks first reduce a bounded number of links each.  Then, round by round, every node is hung below
    its smallest neighbour, paths are halved until nodes point at roots, and links between different
    roots go on to the next round.  A node of any degree only meets partial minima and split joins.
    """
    links = workspace.write(links.select("a", "b").filter("a <> b"), "links")
    tasks = max(1, -(-links.count() // LINKS_PER_TASK))
    left = workspace.write(links.repartition(tasks).mapInArrow(_contract, "a bigint, b bigint"), "contracted")
    labels = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = workspace.write(both.groupBy("a").agg(F.least("a", F.min("b")).alias("up")).withColumnRenamed("a", "node"), "hung")
        while True:
            top = up.select(F.col("node").alias("of"), F.col("up").alias("top"))
            jumped = workspace.write(up.join(top, F.col("up") == F.col("of")).select("node", F.col("top").alias("up"), (F.col("up") != F.col("top")).alias("moved")), "jumped")
            moved = not jumped.filter("moved").isEmpty()
            up = jumped.drop("moved")
            if not moved:
                break
        if labels is None:
            labels = up.withColumnRenamed("up", "component")
        else:
            new = up.select(F.col("node").alias("of"), "up")
            labels = workspace.write(
                labels.join(new, F.col("component") == F.col("of"), "left").select("node", F.coalesce("up", "component").alias("component")), "labels"
            )
        at = up.select(F.col("node").alias("a"), F.col("up").alias("ra"))
        to = up.select(F.col("node").alias("b"), F.col("up").alias("rb"))
        left = workspace.write(
            left.join(at, "a").join(to, "b").filter("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "left"
        )
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))  # no links, no rows
    return labels
