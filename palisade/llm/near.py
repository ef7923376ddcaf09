"""Near duplicates with a MinHash LSH forest.

A document's set are its distinct shingles of ``SHINGLE`` words.  Documents of equal sets form a class
at once; one representative of each class enters the forest.  The forest is ``TREES`` sorted orders of
the representatives, each by ``DEPTH`` MinHash values.  Candidates are neighbours in an order that
share a prefix of at least ``LEAST`` values: all pairs where fewer than ``REACH`` others lie between, so
in a sparse region everything with the shortest prefix, and in a dense one what shares the longest.

Only documents with any neighbour go on.  Two rounds confirm candidates on the full sets: direct
neighbours in ``FIRST_TREES`` orders, which join most of every group, however large; then neighbours up
to ``REACH`` places apart in all orders, of documents that are not in one component yet.  Links inside a
component would not change it, so no group is expanded into pairs.  Pairs whose sizes cannot be similar
are left out, and pairs whose sketches (``NIBBLE`` bits of every MinHash value) put their similarity below
``DOUBTFUL``, six standard errors under 0.75.

A document that shares a shortest prefix with more than ``REACH`` others in an order is crowded: the
neighbours it is compared with need not be the similar ones.  Among the crowded documents all links between
different components are found exactly, by a prefix-filter join: with the shingles of every set ordered
from rare to frequent, two similar sets have a first common shingle so early that the rest of each can hold
the needed overlap.  Postings of a frequent shingle are dealt to pairs of blocks, so no task has all of them.

At a similarity of 0.75 two documents share a prefix of two in an order with a probability of 0.5625, and
in at least one of 24 with 1 - 3e-9; the sketches refuse 3 pairs in 1,000,000,000.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.llm.bytewords import NOT_SPACE, mix, words
from palisade.llm.graph import components
from palisade.llm.tables import Workspace, slices, with_key

SHINGLE = 5
TREES, DEPTH, LEAST = 24, 8, 2
FIRST_TREES = 8
REACH = 16
SIMILAR = 75  # percent
NIBBLE = 4
SLICES = 4
DOUBTFUL = 0.549
BUCKETS = 1 << 18  # of shingle hashes, for counts that only order shingles and size blocks
BLOCK = 1000  # postings
_CHUNK = 1 << 20
_EQUAL = np.array([(x >> 4 == 0) + (x & 15 == 0) for x in range(256)], np.uint8)  # nibbles of a xor that agree
_SEEDS = np.random.default_rng(41).integers(1, 1 << 63, (2, TREES * DEPTH), dtype=np.uint64)


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different 64-bit hashes of each text's shingles, and where each text's begin (one more)."""
    found = words(texts, NOT_SPACE)
    count = np.diff(found.first)
    hashes, text = [], []
    for n in range(1, size + 1):  # texts of fewer words have one shingle of all their words
        at = found.first[:-1][count == n]
        if n == size:
            inside = np.arange(len(found.hash)) + size <= found.first[found.text + 1]
            at = np.flatnonzero(inside & (count[found.text] >= size))
        x = mix(found.hash[at] + np.uint64(n))
        for i in range(1, n):
            x = mix(x * np.uint64(3) + found.hash[at + i])
        hashes.append(x)
        text.append(found.text[at])
    x, of = np.concatenate(hashes), np.concatenate(text)
    order = np.lexsort((x, of))
    x, of = x[order], of[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (of[1:] != of[:-1])
    x, of = x[new], of[new]
    return x, np.searchsorted(of, np.arange(len(texts) + 1))


def signatures(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash values (big-endian, for sorting as bytes) of the sets that are not empty."""
    begin = first[:-1][np.diff(first) > 0]
    out = np.empty((len(begin), TREES * DEPTH), ">u4")
    for i in range(TREES * DEPTH if len(begin) else 0):
        out[:, i] = np.minimum.reduceat((x * (_SEEDS[0, i] | np.uint64(1)) + _SEEDS[1, i]) >> np.uint64(32), begin)
    return out


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(iter([batch]), "text", _CHUNK):
            x, first = shingle_sets([(t or "").encode() for t in part.column("text").to_pylist()])
            sizes = np.diff(first)
            full = np.flatnonzero(sizes)
            names = np.zeros((2, len(sizes)), np.int64)
            if len(full):  # 128 bits that stand for the whole set
                names[0, full] = np.add.reduceat(mix(x), first[full]).view(np.int64)
                names[1, full] = np.add.reduceat(mix(x ^ _SEEDS[1, 0]), first[full]).view(np.int64)
            signed = np.full(len(sizes), None, object)
            signed[full] = [row.tobytes() for row in signatures(x, first)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_key"), part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(names[0]), pa.array(names[1]),
                 pa.array(signed, pa.binary())],
                ["doc_key", "doc_id", "n_shingles", "set_a", "set_b", "signature"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(iter([batch]), "text", _CHUNK):
            x, first = shingle_sets([(t or "").encode() for t in part.column("text").to_pylist()])
            values = pa.array([x[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_key"), values], ["doc_key", "shingles"])


_ROW = "tree int, place binary, doc_key bigint, n_shingles bigint, component bigint, sketch binary"
_PAIR = "a bigint, b bigint"


def _sketch(signature: bytes) -> bytes:
    low = np.frombuffer(signature, ">u4").astype(np.uint8) & 15
    return (low[0::2] << NIBBLE | low[1::2]).tobytes()


def _rows_of_trees(heads: DataFrame) -> DataFrame:
    """One row per order of each of ``doc_key, n_shingles, component, signature``."""

    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            signatures_ = batch.column("signature").to_pylist()
            sketches = pa.array(map(_sketch, signatures_), pa.binary())
            for tree in range(TREES):
                places = [x[4 * DEPTH * tree : 4 * DEPTH * (tree + 1)] for x in signatures_]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree] * len(places), pa.int32()), pa.array(places, pa.binary()), batch.column("doc_key"),
                     batch.column("n_shingles"), batch.column("component"), sketches],
                    [f.split()[0] for f in _ROW.split(", ")],
                )

    return heads.select("doc_key", "n_shingles", "component", "signature").mapInArrow(rows, _ROW)


def _neighbours(rows: pa.Table, reach: int, crowds: bool = False) -> pa.RecordBatch:
    """Pairs of sorted rows at most ``reach`` apart with a common prefix.

    Where rows have sketches, only pairs of different components that may be similar.  With ``crowds``
    also each row of a longer run of one prefix, as a pair with itself.
    """
    n = rows.num_rows
    place = rows.column("place").to_pylist()
    width = len(place[0]) // 4 if n else 0
    place = np.frombuffer(b"".join(place), ">u4").reshape(n, width)
    tree, key, component, size = (rows.column(c).to_numpy() for c in ("tree", "doc_key", "component", "n_shingles"))
    strict = n > 0 and rows.column("sketch").null_count == 0
    sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(n, -1) if strict else None
    prefix = np.concatenate([tree[:, None].astype(np.int64), place[:, :LEAST].astype(np.int64)], axis=1)
    out = [np.empty((2, 0), np.int64)]
    for j in range(1, min(reach, n - 1) + 1):
        same = (prefix[j:] == prefix[:-j]).all(axis=1)
        if not same.any():  # sorted rows: nothing farther apart shares it either
            break
        if strict:
            same &= component[j:] != component[:-j]
            same &= 100 * np.minimum(size[j:], size[:-j]) >= SIMILAR * np.maximum(size[j:], size[:-j])
        i = np.flatnonzero(same)
        if strict and len(i):
            share = _EQUAL[sketch[i] ^ sketch[i + j]].sum(axis=1) / (2 * sketch.shape[1])
            chance = 1 / (1 << NIBBLE)
            i = i[(share - chance) / (1 - chance) >= DOUBTFUL]
        out.append(np.stack([np.minimum(key[i], key[i + j]), np.maximum(key[i], key[i + j])]))
    if crowds and n > reach + 1:
        i = np.flatnonzero((prefix[reach + 1 :] == prefix[: -reach - 1]).all(axis=1))
        runs = np.zeros(n + 1, np.int64)
        runs[i] += 1
        runs[i + reach + 2] -= 1
        crowded = np.unique(key[np.cumsum(runs[:-1]) > 0])
        out.append(np.stack([crowded, crowded]))
    found = np.concatenate(out, axis=1)
    return pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64())], ["a", "b"])


def forest_neighbours(rows: DataFrame, workspace: Workspace, *, reach: int, crowds: bool = False) -> DataFrame:
    """Different pairs ``a, b`` of neighbours in all orders, of which rows are given.

    With ``crowds`` also ``a, a`` of every row in a run of one prefix longer than the neighbours reach.

    Orders are range-partitioned, so a region of any size is spread out.  Each task also reports the
    rows at its two ends; these few are sorted again by tree, which pairs neighbours across tasks.
    """
    order = ["tree", "place", "doc_key"]
    hold = reach + crowds
    kind = f"{_PAIR}, edge struct<{', '.join(f.replace(' ', ': ', 1) for f in _ROW.split(', '))}>"
    types = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [pa.field(name, types[t]) for name, t in (f.split() for f in _ROW.split(", "))]

    def pack(pairs: pa.RecordBatch, edges: pa.Table) -> pa.RecordBatch:
        n, m = pairs.num_rows, edges.num_rows
        columns = [pa.concat_arrays([c, pa.nulls(m, c.type)]) for c in pairs.columns]
        parts = [pa.concat_arrays([pa.nulls(n, f.type), *(c.cast(f.type) for c in edges.column(f.name).chunks)]) for f in fields]
        edge = pa.StructArray.from_arrays(parts, fields=fields, mask=pa.array(np.arange(n + m) < n))
        return pa.RecordBatch.from_arrays([*columns, edge], ["a", "b", "edge"])

    def scan(batches: Iterator[pa.RecordBatch]):
        kept = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            if kept is None:
                yield pack(_neighbours(now.slice(0, 0), reach), now.slice(0, hold))
            else:  # the last rows of the batch before, of which pairs among themselves come twice
                now = pa.concat_tables([kept, now])
            yield pack(_neighbours(now, reach, crowds), now.slice(0, 0))
            kept = now.slice(max(0, now.num_rows - hold)).combine_chunks()
        if kept is not None:
            yield pack(_neighbours(kept.slice(0, 0), reach), kept)

    found = workspace.write(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(scan, kind), "neighbours")
    edges = found.filter("edge IS NOT NULL").select("edge.*").distinct()

    def join(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_neighbours(table.sort_by([(c, "ascending") for c in order]), reach, crowds)])

    across = workspace.write(edges.groupBy("tree").applyInArrow(join, _PAIR), "across")
    return found.filter("edge IS NULL").drop("edge").unionByName(across).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar."""

    def confirm(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_of_a").to_pylist(), batch.column("set_of_b").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                keep.append(False)
                if 100 * len(x) >= SIMILAR * len(y) and len(x):
                    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                    both = int((y[at] == x).sum())
                    keep[-1] = 100 * both >= SIMILAR * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    first = sets.select(F.col("doc_key").alias("a"), F.col("shingles").alias("set_of_a"))
    second = sets.select(F.col("doc_key").alias("b"), F.col("shingles").alias("set_of_b"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "set_of_a", "set_of_b").mapInArrow(confirm, "a bigint, b bigint")


def _bucket(x: np.ndarray) -> np.ndarray:
    return (mix(x) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _postings(sets: list[bytes], often: np.ndarray) -> tuple[np.ndarray, ...]:
    """Shingles that may be the first one common with a similar set, the set of each, its size, and how many
    shingles of the set begin there; in one order of all shingles, the rare ones first."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets)) // 8
    x = np.frombuffer(b"".join(sets), np.uint64)
    of = np.repeat(np.arange(len(sets)), sizes)
    times = often[_bucket(x)]
    order = np.lexsort((x, times, of))
    x, times, size = x[order], times[order], sizes[of]
    left = size - (np.arange(len(x)) - (np.cumsum(sizes) - sizes)[of])
    smallest = -(-SIMILAR * size // 100)  # a similar set has as many shingles at least
    keep = ((100 + SIMILAR) * left >= SIMILAR * (size + smallest)) & (times > 1)
    return x[keep], of[keep], size[keep], left[keep]


def _joined(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Pairs within the groups of sorted rows that may be similar by their first common shingle."""
    shingle, one, other, own, key, component, size, left = (c.to_numpy() for c in rows.columns)
    new = (shingle[1:] != shingle[:-1]) | (one[1:] != one[:-1]) | (other[1:] != other[:-1])
    starts = np.concatenate([[0], np.flatnonzero(new) + 1, [len(shingle)]])
    end = np.repeat(starts[1:], np.diff(starts))
    i, j, out, held = np.arange(len(shingle)), 1, [], 0
    while len(i := i[i + j < end[i]]):
        k = i + j
        good = (component[i] != component[k]) & ((one[i] == other[i]) | (own[i] != own[k]))
        good &= (100 + SIMILAR) * np.minimum(left[i], left[k]) >= SIMILAR * (size[i] + size[k])
        a, b = key[i[good]], key[k[good]]
        out.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
        held += len(a)
        if held > _CHUNK:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(out, axis=1)], ["a", "b"])
            out, held = [], 0
        j += 1
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(out, axis=1)], ["a", "b"])


def crowded_pairs(crowd: DataFrame, workspace: Workspace, *, block: int = BLOCK) -> DataFrame:
    """Pairs ``a, b`` of ``doc_key, component, shingles`` that hold every similar pair of different components.

    The driver gets numbers per bucket, and a bucket that several shingles share only costs time.
    """
    spark = crowd.sparkSession

    def count(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            found, n = np.unique(_bucket(np.frombuffer(b"".join(batch.column("shingles").to_pylist()), np.uint64)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["bucket", "n"])

    counted = crowd.select("shingles").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(BUCKETS, np.int64)
    often[counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    often = spark.sparkContext.broadcast(often)

    def survey(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            x, of, size, left = _postings(batch.column("shingles").to_pylist(), often.value)
            found = _bucket(x)
            order = np.argsort(found, kind="stable")
            found, component = found[order], batch.column("component").to_numpy()[of[order]]
            short = ((100 + SIMILAR) * left >= 2 * SIMILAR * size)[order]  # may be the smaller set of a pair
            first = np.flatnonzero(np.diff(found, prepend=-1))
            if len(first):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[first]), pa.array(np.diff(first, append=len(found))), pa.array(np.add.reduceat(short.astype(np.int64), first)),
                     pa.array(np.minimum.reduceat(component, first)), pa.array(np.maximum.reduceat(component, first))],
                    ["bucket", "n", "short", "low", "high"],
                )

    surveyed = crowd.mapInArrow(survey, "bucket bigint, n bigint, short bigint, low bigint, high bigint").groupBy("bucket")
    surveyed = surveyed.agg(F.sum("n").alias("n"), F.sum("short").alias("short"), F.min("low").alias("low"), F.max("high").alias("high"))
    surveyed = surveyed.filter("short > 0 AND low < high").select("bucket", "n").toArrow()
    blocks = np.zeros(BUCKETS, np.int64)  # none where no pair can be
    blocks[surveyed["bucket"].to_numpy()] = -(-surveyed["n"].to_numpy() // block)
    blocks = spark.sparkContext.broadcast(blocks)
    names = ["shingle", "one", "other", "own", "doc_key", "component", "size", "remaining"]

    def deal(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            x, of, size, left = _postings(batch.column("shingles").to_pylist(), often.value)
            n = blocks.value[_bucket(x)]
            keys, components_ = (batch.column(c).to_numpy()[of] for c in ("doc_key", "component"))
            own = (mix(keys.astype(np.uint64)) % np.maximum(n, 1).astype(np.uint64)).astype(np.int64)
            ends = np.cumsum(n)
            at = 0
            while at < len(n):  # a posting meets every block, so it comes as often
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _CHUNK, "right")))
                times = n[at:to]
                row = np.repeat(np.arange(at, to), times)
                block_ = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in (x[row].view(np.int64), np.minimum(own[row], block_), np.maximum(own[row], block_), own[row],
                                           keys[row], components_[row], size[row], left[row])], names)
                at = to

    def join(batches: Iterator[pa.RecordBatch]):
        kept = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = (pa.concat_tables([kept, now]) if kept is not None else now).combine_chunks()
            last = [now.column(c).to_numpy() for c in names[:3]]
            open_ = np.logical_and.reduce([c == c[-1] for c in last]) if now.num_rows else np.empty(0, bool)
            cut = now.num_rows - int(open_.sum())  # the last group may go on
            kept = now.slice(cut)
            yield from _joined(now.slice(0, cut))
        if kept is not None:
            yield from _joined(kept)

    dealt = crowd.mapInArrow(deal, ", ".join(f"{c} bigint" for c in names))
    return dealt.repartition(*names[:3]).sortWithinPartitions(*names[:3]).mapInArrow(join, _PAIR).distinct()


def near_duplicates(docs: DataFrame, workspace: Workspace) -> DataFrame:
    """``doc_key, doc_id, n_shingles, component_id, component_key`` of every document row.

    A null or empty text, or one of white space, has no shingle and is its own component.  Rows that
    repeat a text are one class.  A null doc_id is smaller than any other; rows that share a doc_id are
    ordered by their texts.
    """
    keyed = with_key(docs, workspace)
    kind = docs.schema["doc_id"].dataType.simpleString()
    sketch = workspace.write(
        keyed.mapInArrow(_sketches, f"doc_key bigint, doc_id {kind}, n_shingles bigint, set_a bigint, set_b bigint, signature binary"),
        "sketches",
    )
    same = ["n_shingles", "set_a", "set_b"]
    classes = workspace.write(sketch.filter("n_shingles > 0").groupBy(*same).agg(F.min("doc_key").alias("class")), "classes")
    heads = sketch.join(classes.select(F.col("class").alias("head")), F.col("doc_key") == F.col("head"), "left_semi")
    heads = heads.select("doc_key", "n_shingles", F.col("doc_key").alias("component"), "signature")
    prefixes = heads.select(
        F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.substring("signature", t * (4 * DEPTH) + 1, F.lit(4 * LEAST))))
        .alias("tree", "place"), "doc_key", "n_shingles", "component", F.lit(None).cast("binary").alias("sketch"),
    )
    near = forest_neighbours(prefixes, workspace, reach=1)
    met = workspace.write(near.select(F.explode(F.array("a", "b")).alias("of")).distinct(), "met")
    heads = workspace.write(heads.join(met, F.col("doc_key") == F.col("of"), "left_semi"), "heads")
    narrow = workspace.write(sketch.drop("signature"), "rows")
    workspace.remove(sketch)
    # Texts meet the documents that go on in slices, so that only a part of them lies in a shuffle at a time.
    slice_of = F.pmod(F.xxhash64(F.lit(SLICES), "doc_key"), F.lit(SLICES))
    parts = []
    for i in range(SLICES):
        texts = keyed.select("doc_key", "text").filter(slice_of == i)
        wanted = met.withColumnRenamed("of", "doc_key").filter(slice_of == i)
        parts.append(workspace.write(texts.join(wanted, "doc_key", "left_semi").mapInArrow(_sets, "doc_key bigint, shingles binary"), "sets"))
    sets = reduce(DataFrame.unionByName, parts)

    rows = _rows_of_trees(heads).filter(F.col("tree") < FIRST_TREES)
    first = workspace.write(forest_neighbours(rows, workspace, reach=1), "pairs-1")
    found = components(workspace.write(_confirmed(first, sets), "links-1"), workspace)

    joined = heads.drop("component").join(found, F.col("doc_key") == F.col("node"), "left").withColumn("component", F.coalesce("component", "doc_key"))
    wide = forest_neighbours(_rows_of_trees(joined), workspace, reach=REACH, crowds=True)
    crowded = workspace.write(wide.filter("a = b").select(F.col("a").alias("doc_key")), "crowded")
    # What the first round has refused is refused again.
    second = workspace.write(wide.filter("a < b").join(first, ["a", "b"], "left_anti"), "pairs-2")
    more = workspace.write(_confirmed(second, sets), "links-2")
    stars = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    found = components(stars.unionByName(more), workspace)
    if not crowded.isEmpty():
        crowd = crowded.join(found, F.col("doc_key") == F.col("node"), "left").select("doc_key", F.coalesce("component", "doc_key").alias("component"))
        crowd = workspace.write(sets.join(crowd, "doc_key"), "crowd")
        third = workspace.write(crowded_pairs(crowd, workspace), "pairs-3")
        rest = workspace.write(_confirmed(third, crowd.select("doc_key", "shingles")), "links-3")
        workspace.remove(crowd)
        stars = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = components(stars.unionByName(rest), workspace)
    for part in parts:
        workspace.remove(part)

    reached = workspace.write(
        classes.join(found, F.col("class") == F.col("node"), "left").select(*same, F.coalesce("component", "class").alias("component_key")),
        "reached",
    )
    rows = narrow.join(reached, same, "left").withColumn("component_key", F.coalesce("component_key", "doc_key"))
    smallest = narrow.select(F.col("doc_key").alias("of"), F.col("doc_id").alias("component_id"))
    return rows.join(smallest, F.col("component_key") == F.col("of")).select("doc_key", "doc_id", "n_shingles", "component_id", "component_key")


def near_digest(docs: DataFrame, workspace: Workspace) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``."""
    kept = (F.col("doc_key") == F.col("component_key")).alias("kept")
    return near_duplicates(docs, workspace).select("doc_id", "n_shingles", "component_id", kept)


def keep_one_of_each(docs: DataFrame, workspace: Workspace) -> DataFrame:
    """The rows of ``docs``, one of each component: the one of the smallest doc_id."""
    packed = with_key(docs.select("doc_id", "text", F.struct(*docs.columns).alias("row")), workspace, extra=("row",))
    found = near_duplicates(packed.select(F.col("doc_key").alias("doc_id"), "text"), workspace)
    # The dropped ones are the fewer, so that Spark may look them up without shuffling the texts.
    dropped = workspace.write(found.filter("doc_key <> component_key").select(F.col("doc_key").alias("of")), "dropped")
    return packed.join(dropped, F.col("doc_key") == F.col("of"), "left_anti").select("row.*")
