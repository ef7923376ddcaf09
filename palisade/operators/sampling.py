"""Exact splits, class balancing and class weights, for any number of classes.

A draw per row is cut at an exact rank: the draws are counted by their leading bits, the one counting cell that holds
the cut is looked at row by row, and the cuts come back as a table of one row per class that is joined.  Sizes and
cuts of classes stay tables throughout; the driver sees totals only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.config import HOLDOUT_FRACTION, RANDOM_SEED
from palisade.functions.draws import DRAW_BITS, hashed_draw
from palisade.operators.running import running_totals
from palisade.schema import quoted
from palisade.session import cut_lineage, settle_small, shared_folder

ROWS_PER_CELL = 4096
TREE_BITS = 8  # of the draw that one level of the bootstrap's tree looks at


def _settled(df: DataFrame, name: str) -> DataFrame:
    """A table of classes, materialised so that Spark knows its size when it plans a join with it."""
    out = cut_lineage(df, name)
    if shared_folder(df.sparkSession) is None:
        out.count()
    return out


def class_sizes(df: DataFrame, label: str | None) -> DataFrame:
    """``(_class, n)``: the rows of each class; a missing label is a class."""
    key = F.col(quoted(label)) if label else F.lit(0)
    return _settled(df.groupBy(key.alias("_class")).agg(F.count(F.lit(1)).alias("n")), "classes")


def with_train_sizes(classes: DataFrame, holdout: float, of: str = "n", output: str = "train") -> DataFrame:
    """Add the training rows of each class; the total is exact and leftovers go to the largest remainders.

    Among equal remainders the smaller classes, by value, come first, a missing one last.  A remainder depends on
    a class's size only, so all but the last choice is made on the table of different sizes, which has at most the
    square root of twice the rows; only the classes with the remainder at which the leftovers run out are ranked.
    """
    size = F.col("_n").cast("decimal(19,0)")
    everywhere = Window.partitionBy(F.lit(0))
    total = F.greatest(F.sum(F.col("_n") * F.col("classes")).over(everywhere), F.lit(1))
    train = F.col("total") - F.ceil(F.lit(holdout) * F.col("total") - F.lit(1e-9))
    product = size * F.col("train").cast("decimal(19,0)")
    whole = F.col("total").cast("decimal(19,0)")
    leftover = F.col("train") - F.sum(F.col("floor") * F.col("classes")).over(everywhere)
    upto, same = F.sum("classes").over(everywhere.orderBy(F.desc("left"))), F.sum("classes").over(Window.partitionBy("left"))
    rule = _settled(
        classes.groupBy(F.col(of).cast("bigint").alias("_n")).agg(F.count(F.lit(1)).alias("classes"))
        .withColumn("total", total).withColumn("train", train)
        .withColumn("left", (product % whole).cast("bigint")).withColumn("floor", ((product - product % whole) / whole).cast("bigint"))
        .withColumns({"leftover": leftover, "upto": upto, "same": same})
        .withColumn("take", F.greatest(F.lit(0), F.least("same", F.col("leftover") - F.col("upto") + F.col("same"))))
        .select("_n", "floor", "left", "take", "same"),
        "sizes",
    )
    sized = classes.join(rule, F.col(of) == F.col("_n"))
    more = F.col("take") == F.col("same")
    last = rule.filter((F.col("take") > 0) & (F.col("take") < F.col("same"))).first()
    if last:
        tied = sized.filter((F.col("left") == last["left"]) & F.col("_class").isNotNull())  # a missing one comes last
        ranked = running_totals(tied.select("_class", F.lit(1).alias("one")), "_class", ["one"])
        chosen = ranked.filter(F.col("one_before") < last["take"]).select(F.col("_class").alias("_chosen"))
        sized = sized.join(chosen, F.col("_class") == F.col("_chosen"), "left")
        more = more | F.col("_chosen").isNotNull()
    return sized.select(*classes.columns, (F.col("floor") + F.when(more, 1).otherwise(0)).alias(output))


def _drawn(df: DataFrame, label: str | None, row_id: str, draw: Column | None, seed: int) -> DataFrame:
    return df.select(
        "*",
        (F.col(quoted(label)) if label else F.lit(0)).alias("_class"),
        (draw if draw is not None else hashed_draw(seed, F.col(quoted(row_id)))).alias("_draw"),
    )


def _cell_bits(rows: int) -> int:
    """Leading bits of the draw, enough of them that one cell holds few rows."""
    return max(1, min(DRAW_BITS, (rows // ROWS_PER_CELL).bit_length()))


def _cell(bits: int) -> Column:
    return F.shiftright("_draw", DRAW_BITS - bits)


def _cuts(drawn: DataFrame, row_id: str, classes: DataFrame, ends: list[str]) -> DataFrame:
    """``_of`` and, for each end, the struct ``_cut<i>`` (draw, id) of the class's row of that rank; null for rank 0."""
    bits = _cell_bits(classes.agg(F.max(F.greatest(*ends, F.lit(0)))).first()[0] or 1)
    keys = drawn.select("_class", _cell(bits).alias("_cell"), "_draw", F.col(quoted(row_id)).alias("_id"))
    per_cell = keys.groupBy("_class", "_cell").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("_class").orderBy("_cell"))  # a row for thousands of rows of a class
    placed = per_cell.withColumn("n_before", upto - F.col("n"))
    wanted = classes.select(
        F.col("_class").alias("_of"), F.inline(F.array(*[F.struct(F.lit(i).alias("part"), F.col(e).cast("bigint").alias("end")) for i, e in enumerate(ends)]))
    ).filter("end > 0")
    holding = _settled(
        placed.join(wanted, F.col("_class").eqNullSafe(F.col("_of")) & (F.col("n_before") < F.col("end")) & (F.col("end") <= F.col("n_before") + F.col("n")))
        .select("_of", F.col("_cell").alias("_at"), "part", (F.col("end") - F.col("n_before")).alias("rank")),
        "holding",
    )
    # With a plain equality Spark would filter on the cell first, and so compute each row's draw twice.
    inside = keys.join(holding, F.col("_class").eqNullSafe(F.col("_of")) & F.col("_cell").eqNullSafe(F.col("_at")))
    place = F.row_number().over(Window.partitionBy("_of", "part").orderBy("_draw", "_id"))  # the rows of a cell
    found = inside.withColumn("place", place).filter(F.col("place") == F.col("rank"))
    cut = F.struct(F.col("_draw").alias("draw"), F.col("_id").alias("id"))
    return found.groupBy("_of").agg(*[F.max(F.when(F.col("part") == i, cut)).alias(f"_cut{i}") for i in range(len(ends))])


def split_parts(
    df: DataFrame,
    classes: DataFrame,
    ends: list[str],
    *,
    label: str | None,
    row_id: str,
    output: str = "part",
    draw: Column | None = None,
    seed: int = RANDOM_SEED,
) -> DataFrame:
    """Number the parts of a random partition: the first i + 1 parts of a class have the rows that ``ends[i]`` says.

    ``classes`` has a row per class: ``_class`` and the columns ``ends``, which do not decrease.  Rows beyond the
    last end get the next number.  ``row_id`` must be unique.
    """
    drawn = _drawn(df, label, row_id, draw, seed)
    lookup = _settled(_cuts(drawn, row_id, classes, ends), "cuts")
    marked = drawn.join(lookup, F.col("_class").eqNullSafe(F.col("_of")), "left")  # Spark broadcasts it if it is small
    part = F.lit(0)
    for i in range(len(ends)):
        cut = F.col(f"_cut{i}")
        beyond = cut.isNull() | (F.col("_draw") > cut["draw"]) | ((F.col("_draw") == cut["draw"]) & (F.col(quoted(row_id)) > cut["id"]))
        part = part + F.when(beyond, 1).otherwise(0)
    return marked.select(*[F.col(quoted(c)) for c in df.columns], part.alias(output))


def holdout_parts(
    df: DataFrame,
    *,
    row_id: str,
    label: str | None,
    fraction: float = HOLDOUT_FRACTION,
    output: str = "part",
    draw: Column | None = None,
    seed: int = RANDOM_SEED,
) -> DataFrame:
    """Mark the training rows 0 and the holdout 1, with exact sizes; ``label=None`` splits without classes."""
    classes = with_train_sizes(class_sizes(df, label), fraction)
    return split_parts(df, classes, ["train"], label=label, row_id=row_id, output=output, draw=draw, seed=seed)


def three_way_parts(
    df: DataFrame,
    *,
    row_id: str,
    label: str | None,
    test: float = HOLDOUT_FRACTION,
    validation: float = HOLDOUT_FRACTION,
    output: str = "part",
    draw: Column | None = None,
    seed: int = RANDOM_SEED,
) -> DataFrame:
    """Mark training, validation and test rows 0, 1 and 2 in one draw; every row lands in exactly one part."""
    seen = with_train_sizes(class_sizes(df, label), test, output="seen")
    classes = with_train_sizes(seen, validation, of="seen")
    return split_parts(df, classes, ["train", "seen"], label=label, row_id=row_id, output=output, draw=draw, seed=seed)


def _pieces(marked: DataFrame, n: int) -> tuple[DataFrame, ...]:
    return tuple(marked.filter(F.col("_part") == i).drop("_part") for i in range(n))


def holdout_split(df: DataFrame, **settings) -> tuple[DataFrame, DataFrame]:
    """(train, holdout) of :func:`holdout_parts`."""
    return _pieces(holdout_parts(df, output="_part", **settings), 2)


def three_way_split(df: DataFrame, **settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, validation, test) of :func:`three_way_parts`."""
    return _pieces(three_way_parts(df, output="_part", **settings), 3)


def undersample(
    df: DataFrame, *, row_id: str, label: str, draw: Column | None = None, seed: int = RANDOM_SEED
) -> DataFrame:
    """Every class cut to the size of the smallest one, without replacement."""
    df = df.filter(F.col(quoted(label)).isNotNull())
    classes = class_sizes(df, label)
    smallest = classes.agg(F.min("n")).first()[0] or 0
    classes = classes.withColumn("end", F.lit(smallest).cast("bigint"))
    marked = split_parts(df, classes, ["end"], label=label, row_id=row_id, output="_part", draw=draw, seed=seed)
    return _pieces(marked, 1)[0]


def _shared_out(seed: int):
    """Split the picks of a node among its children, in proportion to their rows and at random."""

    def run(children: pa.Table) -> pa.Table:
        order = np.argsort(children.column("_node").to_numpy())
        children = children.take(pa.array(order))
        n = children.column("n").to_numpy()
        draw = np.random.default_rng([seed, children.column("_hash")[0].as_py() % (1 << 63), children.column("_parent")[0].as_py()])
        picks = draw.multinomial(children.column("_picks")[0].as_py(), n / n.sum())
        return children.drop_columns(["_picks", "_parent"]).append_column("_picks", pa.array(picks, pa.int64()))

    return run


def _bootstrapped(seed: int, schema: list[str]):
    """Give the rows of a cell, which come one after the other, the cell's picks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, times = None, np.empty(0, np.int64)
        for batch in batches:
            out = np.empty(batch.num_rows, np.int64)
            keys = list(zip(*[batch.column(c).to_pylist() for c in ("_hash", "_cell")], strict=True))
            starts = [i for i in range(len(keys)) if (keys[i - 1] if i else at) != keys[i]]
            for begin, end in zip([0, *starts], [*starts, len(keys)], strict=True):
                if begin in starts:
                    at = keys[begin]
                    n, picks = (batch.column(c)[begin].as_py() for c in ("_n", "_picks"))
                    times = np.random.default_rng([seed + 1, at[0] % (1 << 63), at[1]]).multinomial(picks, np.full(n, 1 / n))
                out[begin:end], times = times[: end - begin], times[end - begin :]
            kept = [batch.column(c) for c in schema]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(out)], [*schema, "_times"])

    return run


def oversample(df: DataFrame, *, row_id: str, label: str, seed: int = RANDOM_SEED, times: str | None = None) -> DataFrame:
    """Every class smaller than the largest becomes a bootstrap of that size; the largest stays.

    With ``times`` each picked row comes once, and that column says how often it was picked: joins and counts then
    move no copies.  Without it each row comes as often as it was picked.

    A bootstrap is the number of times that each row is picked.  The picks of a class are split down a tree over the
    leading bits of the rows' draws, each node's among its children by a multinomial draw in proportion to their
    rows, and at last among the rows of a cell.  The draws depend on the seed, the class and the node, so the result
    is the same under any partitioning.  Rows are shuffled once, by small cells; there is no table of picks.  Rows
    without a class are left out.
    """
    names = df.columns
    classes = class_sizes(df.filter(F.col(quoted(label)).isNotNull()), label)
    largest = classes.agg(F.max("n")).first()[0] or 0
    hashed = F.xxhash64(F.col("_class").cast("string"))
    smaller = classes.filter(F.col("n") < largest).select(F.col("_class").alias("_of"))
    drawn = _drawn(df, label, row_id, None, seed).join(smaller, F.col("_class") == F.col("_of"), "left_semi")
    levels = -(-_cell_bits(largest) // TREE_BITS)
    bits = TREE_BITS * levels
    cells = _settled(drawn.groupBy("_class", _cell(bits).alias("_cell")).agg(F.count(F.lit(1)).alias("n")), "cells")
    picks = smaller.select(F.col("_of").alias("_class"), F.lit(0).cast("bigint").alias("_parent"), F.lit(largest).cast("bigint").alias("_picks"))
    kind = df.schema[label].dataType.simpleString()
    for level in range(1, levels + 1):
        below = TREE_BITS * (levels - level)
        nodes = cells.groupBy("_class", F.shiftright("_cell", below).alias("_node")).agg(F.sum("n").alias("n"))
        nodes = nodes.withColumn("_parent", F.shiftright("_node", TREE_BITS)).withColumn("_hash", hashed)
        shared = nodes.join(picks.select("_class", "_parent", "_picks"), ["_class", "_parent"]).select("_class", "_hash", "_node", "_parent", "n", "_picks")
        split = shared.groupBy("_class", "_parent").applyInArrow(_shared_out(seed), f"_class {kind}, _hash bigint, _node bigint, n bigint, _picks bigint")
        picks = _settled(split.select("_class", F.col("_node").alias("_parent"), "_picks", "n", "_hash"), "picks")
    leaves = picks.select(F.col("_class").alias("_of"), F.col("_parent").alias("_at"), F.col("n").alias("_n"), "_picks", "_hash")
    rows = drawn.withColumn("_cell", _cell(bits)).join(leaves, (F.col("_class") == F.col("_of")) & (F.col("_cell") == F.col("_at")))
    rows = rows.select(*[F.col(quoted(c)) for c in names], "_hash", "_cell", "_draw", "_n", "_picks")
    spread = rows.repartition("_hash", "_cell").sortWithinPartitions("_hash", "_cell", "_draw", quoted(row_id))
    counted = spread.mapInArrow(_bootstrapped(seed, names), T.StructType([*df.schema.fields, T.StructField("_times", T.LongType())]))
    picked = counted.filter("_times > 0")
    whole = classes.filter(F.col("n") == largest).select(F.col("_class").alias("_of"))
    kept = df.join(whole, F.col(quoted(label)) == F.col("_of"), "left_semi")
    columns = [F.col(quoted(c)) for c in names]
    if times is not None:
        once = F.lit(1).cast("bigint").alias(times)
        return kept.select(*columns, once).unionByName(picked.select(*columns, F.col("_times").alias(times)))
    repeated = picked.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_times").cast("int"))))
    return kept.select(*columns).unionByName(repeated.select(*columns))


def balance(df: DataFrame, *, row_id: str, label: str, strategy: str = "oversample", seed: int = RANDOM_SEED):
    if strategy == "oversample":
        return oversample(df, row_id=row_id, label=label, seed=seed)
    if strategy == "undersample":
        return undersample(df, row_id=row_id, label=label, seed=seed)
    raise ValueError(f"unknown balancing strategy {strategy!r}")


def class_weights(df: DataFrame, label: str, strategy: str = "balanced") -> DataFrame:
    """(class, weight): balanced = rows / (classes * rows of the class), uniform = 1."""
    counts = (
        df.filter(F.col(quoted(label)).isNotNull())
        .groupBy(F.col(quoted(label)).alias("class"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if strategy == "uniform":
        return counts.select("class", F.lit(1.0).alias("weight"))
    if strategy == "balanced":
        return counts.select("class", (counts.agg(F.avg("n")).scalar() / F.col("n")).alias("weight"))
    raise ValueError(f"unknown weighting strategy {strategy!r}")


def with_class_weight(df: DataFrame, label: str, output: str = "weight") -> DataFrame:
    """Add the balanced class weight to each row; a row without a class gets none.

    The weights are a table of one row per class and are joined, however many classes there are; rows of a few classes
    stay in the tasks that they are in.
    """
    weights = class_weights(df, label).select(F.col("class").alias("_class"), F.col("weight").alias("_weight_of"))
    weights, small = settle_small(weights)  # else all rows of a class would be shuffled into one task
    joined = df.join(F.broadcast(weights) if small else weights, F.col(quoted(label)) == F.col("_class"), "left")
    return joined.select(*[F.col(quoted(c)) for c in df.columns], F.col("_weight_of").alias(output))
