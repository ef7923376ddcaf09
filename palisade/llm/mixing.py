"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every document falls into a block of its source by a hash of its key; blocks are the units of a draw.
A source's target is some whole passes over its blocks and a part of one more pass, in a permuted order
of blocks; one last block is cut between two documents, where the words come nearest to the target.

The blocks drawn from each source are exact quotas.  A binary tree over the output shards splits them:
at each node the left half gets a multivariate-hypergeometric sample of the node's quotas, as if the
drawn blocks of all sources were dealt out at random.  A shard then takes the next blocks of each
source in permuted order, so shards are disjoint, and shuffles its rows locally.

The driver sees one row per source (sizes, targets, quotas per shard).  Blocks and documents stay in
tables: sums are partial per block, and a source of any size is spread over its blocks.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from palisade.llm.tables import Workspace, with_key

# Fixed values of the mix.
WEIGHTS = (3, 1, 2)  # by source in code point order, repeating; a null source comes last
TOTAL_SHARE = Fraction(3, 2)
MOST_PASSES = 2
WORD = r"[^\x20\x09-\x0D]+"

BLOCKS = 1024  # of a source at least
SHARDS = 64  # at least
SHARD_WORDS = 1 << 27  # of the mix, about; larger mixes have more shards
BLOCKS_PER_SHARD = 16  # a source with a whole shard's words has so many blocks for it
SEED = 17


def targets(sizes: list[int], weights: list[int], total: Fraction, most: int = MOST_PASSES) -> list[Fraction]:
    """Shares of the total by weight; what goes beyond ``most`` times a size is shared again by the others."""
    out = [Fraction(0)] * len(sizes)
    free = set(range(len(sizes)))
    left = Fraction(total)
    while free:
        weight = sum(weights[i] for i in free)
        over = {i for i in free if weights[i] * left / weight > most * sizes[i]}
        if not over:
            for i in free:
                out[i] = weights[i] * left / weight
            break
        for i in over:
            out[i] = Fraction(most * sizes[i])
            left -= out[i]
        free -= over
    return out


def split_quotas(quotas: list[int], shards: int, seed: int = SEED) -> np.ndarray:
    """Blocks of each source (rows) for each shard (columns); rows sum up to the quotas.

    Shards get equal numbers of blocks, but for one more or less.
    """
    out = np.zeros((len(quotas), shards), np.int64)

    def split(node: int, low: int, high: int, counts: np.ndarray) -> None:
        if high - low == 1:
            out[:, low] = counts
            return
        middle = (low + high) // 2
        n_left = int(counts.sum()) * (middle - low) // (high - low)
        draw = np.random.default_rng([seed, node])
        left = draw.multivariate_hypergeometric(counts, n_left, method="marginals")
        split(2 * node, low, middle, left)
        split(2 * node + 1, middle, high, counts - left)

    if len(quotas):
        split(1, 0, shards, np.array(quotas, np.int64))
    return out


def _order(*columns: Column | str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def _sources(sized: DataFrame, shards: int, blocks: int) -> tuple[DataFrame, list, int]:
    """Per source its size, target, passes, words of the last pass and blocks; in order; and the shards."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("words")).collect()
    rows.sort(key=lambda r: (r.source is None, r.source))  # Python compares by code point
    sizes = [r.words for r in rows]
    total = TOTAL_SHARE * sum(sizes)
    while shards * SHARD_WORDS < total:
        shards *= 2
    wanted = targets(sizes, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(rows))], total)
    facts = []
    for row, size, target in zip(rows, sizes, wanted, strict=True):
        passes = int(target // size) if size else 0
        n_blocks = max(blocks, size * BLOCKS_PER_SHARD // SHARD_WORDS)
        facts.append((row.source, size, float(target), passes, float(target - passes * size), n_blocks))
    kind = "of string, source_size bigint, target double, passes int, more double, n_blocks bigint"
    return sized.sparkSession.createDataFrame(facts, kind), [r.source for r in rows], shards


def _plan(blocked: DataFrame, sources: list, workspace: Workspace, shards: int, seed: int) -> DataFrame:
    """One row per block: ``source, block, source_size, target, left, shards``.

    ``shards`` has the shard of every draw of the block.  A block that is cut has ``left`` words to be
    taken in its last draw, others null.
    """
    spark = blocked.sparkSession
    facts = ["source_size", "target", "passes", "more"]
    by_block = blocked.groupBy("source", "block", *facts).agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("rank", "block").rowsBetween(Window.unboundedPreceding, -1)
    planned = workspace.write(
        by_block.withColumn("rank", _order("source", "block", seed=seed))
        .withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
        .withColumn("extra", (F.col("before") < F.col("more")) & (F.col("words") > 0))
        .withColumn("left", F.when(F.col("extra") & (F.col("before") + F.col("words") > F.col("more")),
                                   F.col("more") - F.col("before")))
        .withColumn("n_draws", F.col("passes") + F.col("extra").cast("int")),
        "block-plan",
    )
    draws = planned.filter("n_draws > 0").select("source", "block", F.explode(F.sequence(F.lit(1), F.col("n_draws"))).alias("turn"))
    quota = {r.source: r["count"] for r in draws.groupBy("source").count().collect()}
    ends = np.cumsum(split_quotas([quota.get(s, 0) for s in sources], shards, seed), axis=1)
    begins = np.concatenate([np.zeros((len(sources), 1), np.int64), ends[:, :-1]], axis=1)
    places = spark.createDataFrame(
        [(sources[i], int(j), int(begins[i, j]) + 1, int(ends[i, j])) for i, j in np.argwhere(ends > begins)],
        "of string, shard int, low bigint, high bigint",
    ).select("of", "shard", F.explode(F.sequence("low", "high")).alias("at"))
    place = F.row_number().over(Window.partitionBy("source").orderBy(_order("source", "turn", "block", seed=seed + 1), "turn", "block"))
    dealt = (
        draws.withColumn("place", place.cast("long"))
        .join(places, F.col("source").eqNullSafe(F.col("of")) & (F.col("place") == F.col("at")))
        .groupBy("source", "block").agg(F.sort_array(F.collect_list(F.struct("turn", "shard"))).alias("turns"))
        .select(F.col("source").alias("of"), F.col("block").alias("in"), F.transform("turns", lambda x: x["shard"]).alias("shards"))
    )
    return workspace.write(
        planned.join(dealt, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("in")), "left").select(
            "source", "block", "left", F.coalesce("shards", F.array().cast("array<int>")).alias("shards"),
        ),
        "mix-plan",
    )


def mix(docs: DataFrame, workspace: Workspace, *, carry: tuple[str, ...] = (), shards: int = SHARDS,
        blocks: int = BLOCKS, seed: int = SEED) -> DataFrame:
    """Every document with its draws: ``doc_key, doc_id, size, source_size, target, shards`` and ``carry``.

    ``shards`` lists the output shard of each time the document is taken (twice at most, none if it is
    not).  Size counts words; a null text has none, and its document goes where its block goes, but is
    left out where the block is cut.  A null source is a source.  Repeated rows and ids are documents
    of their own.  The same rows give the same mix on any cluster.
    """
    keyed = with_key(docs, workspace, extra=("source", *carry))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    sizes = workspace.write(keyed.select("doc_key", "doc_id", "source", size), "sizes")
    facts, sources, shards = _sources(sizes, shards, blocks)
    blocked = (
        sizes.join(facts, F.col("source").eqNullSafe(F.col("of"))).drop("of")
        .withColumn("block", F.pmod(_order("doc_key", seed=seed + 2), F.col("n_blocks"))).drop("n_blocks")
    )
    plan = _plan(blocked, sources, workspace, shards, seed).withColumnsRenamed({"source": "of", "block": "in"})
    placed = workspace.write(
        blocked.join(plan, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("in"))).drop("of", "in", "block", "passes", "more"),
        "placed",
    )
    # Inside the one cut block of a source: documents in the order of a hash, up to the nearest end.
    order = Window.partitionBy("source").orderBy(_order("doc_key", seed=seed + 3), "doc_key")
    cut = (
        placed.filter("left IS NOT NULL").select("source", "doc_key", "size", "left")
        .withColumn("upto", F.sum("size").over(order))
        .filter((F.col("upto") - F.col("size") / 2 > F.col("left")) | (F.col("size") == 0))
        .select(F.col("doc_key").alias("out_key"))
    )
    drawn = placed.join(cut, F.col("doc_key") == F.col("out_key"), "left").withColumn(
        "shards", F.when(F.col("out_key").isNull(), F.col("shards")).otherwise(F.slice("shards", F.lit(1), F.size("shards") - 1))
    ).select("doc_key", "doc_id", "size", "source_size", "target", "shards")
    return drawn.join(keyed.select("doc_key", *carry), "doc_key") if carry else drawn


def mix_digest(docs: DataFrame, workspace: Workspace, **settings) -> DataFrame:
    """``doc_id, size, source_size, target, taken``."""
    taken = (F.col("size") * F.size("shards")).cast("long").alias("taken")
    return mix(docs, workspace, **settings).select("doc_id", "size", "source_size", "target", taken)


def mixed_rows(docs: DataFrame, workspace: Workspace, *, seed: int = SEED, **settings) -> DataFrame:
    """The mix itself: the rows of ``docs``, as often as they are taken, by shard and shuffled in each."""
    packed = docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("row"))
    drawn = mix(packed, workspace, carry=("row",), seed=seed, **settings)
    rows = drawn.select("doc_key", "row", F.posexplode("shards").alias("turn", "shard"))
    order = _order("shard", "doc_key", "turn", seed=seed + 4)
    return rows.repartition("shard").sortWithinPartitions("shard", order).select("row.*")
