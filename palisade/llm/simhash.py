"""Near duplicates by SimHash, joined on a grid of segment popcounts.

A document's fingerprint has 64 bits: a bit is set if it is set in over half of the XXH64 hashes (seed 42) of its
shingles of ``SHINGLE`` words, repeats included.  Two fingerprints are linked if they differ in at most ``RADIUS``
bits.  Equal fingerprints are one class; one row per class goes on.

A fingerprint is mapped to the number of set bits in each of its 32 segments of two bits.  The Manhattan distance
of two such vectors is at most the number of differing bits, so linked fingerprints lie within ``RADIUS`` of each
other in that space.  The segments form three bands.  Of three band distances that add up to 4 at most, the two
smallest add up to 2 at most.  So for one of the three pairs of bands, the two vectors are at most 2 apart there,
and both are at most one unit away from some point of the integer grid.  Each fingerprint therefore goes, for every
pair of bands, to its own grid cell and to the cells one unit away (about 33), and linked ones meet in a cell.
Whoever meets is verified on all 64 bits.

A cell may hold a large group of copies whose fingerprints differ a little.  Such groups are not expanded into
pairs.  Cells are range-partitioned and sorted, and in a first round each fingerprint is only compared with the next
``REACH`` of its cell; that joins most of every group.  A second round is exact for the rest: cells whose rows all
belong to one component are done; in the others every row that is not of the cell's largest component is compared
with the rows of other components.  Both rounds read and write thin rows (cell, fingerprint, component), and hot
cells of the second round's join are split by Spark.  The pairs of the second round grow with the rows of a cell
times its rows outside its largest component.

A null or empty text, or one of white space, has no shingle; its fingerprint is zero and is linked like any other.
A text with fewer words than a shingle is one shingle.  Rows that repeat a doc_id or a text are rows of their own.
A null doc_id names no component unless all of the component's are null.  An empty table gives no rows.  Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.llm.bytewords import FOLD, NOT_SPACE
from palisade.llm.graph import components
from palisade.llm.tables import Workspace, slices

SHINGLE, SEED, RADIUS = 4, 42, 4
REACH = 4  # rows of a cell that a row is compared with in the first round
PER_TASK = 20_000  # fingerprints that a task maps to cells
BATCH = 4 << 20  # bytes of text at a time
_CHUNK = 1 << 18  # hashes at a time
_PAIRS_OF_EACH_TWO = 0x5555555555555555
#: Segment i is bits 2i and 2i + 1; the bands are segments 0-10, 11-21 and 22-31.
BANDS = [(0, 11), (11, 22), (22, 32)]


def _text_words(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of a text, A-Z lower-cased and with one space between them; where each starts and ends."""
    data = FOLD[np.frombuffer(text + b" ", np.uint8)]
    inside = NOT_SPACE[data]
    keep = inside.copy()
    keep[1:] |= inside[:-1]  # the first separator after a word
    data, inside = data[keep], inside[keep]
    data[~inside] = 0x20
    ends = np.flatnonzero(~inside)
    return data.tobytes(), np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends, ends


def fingerprint(text: bytes | None) -> int:
    """The fingerprint of a text, as a signed 64-bit number."""
    data, start, end = _text_words(text or b"")
    if not len(end):
        return 0
    start, end = start[: max(1, len(start) - SHINGLE + 1)], end[min(SHINGLE, len(end)) - 1 :]
    hashed = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for at in range(0, len(start), _CHUNK):
        cuts = zip(start[at : at + _CHUNK].tolist(), end[at : at + _CHUNK].tolist(), strict=True)
        hashes = np.array([hashed(data[a:b], SEED) for a, b in cuts], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    set_ = np.packbits(2 * total > len(start), bitorder="little")
    return int(set_.view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", BATCH):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        values = pa.array([fingerprint(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), values], ["doc_id", "fingerprint"])


def _mask(bands: list[int]) -> int:
    return sum(3 << 2 * i for b in bands for i in range(*BANDS[b]))


def segment_counts(value: np.ndarray) -> np.ndarray:
    """The set bits of the 32 segments of two bits, in two bits each."""
    return value - (value >> np.uint64(1) & np.uint64(_PAIRS_OF_EACH_TWO))


def grid_cells(value: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Band left out, cells and their fingerprints: own and neighbouring cells of the other two bands.

    A segment that has no next count has no neighbour there.
    """
    counts = segment_counts(value)
    for without in range(3):
        bands = [b for b in range(3) if b != without]
        own = counts & np.uint64(_mask(bands))
        yield without, own, value
        for i in (i for b in bands for i in range(*BANDS[b])):
            here, unit = own >> np.uint64(2 * i) & np.uint64(3), np.uint64(1 << 2 * i)
            yield without, own[here < 2] + unit, value[here < 2]
            yield without, own[here > 0] - unit, value[here > 0]


_CELL = "without tinyint, cell bigint, value bigint"


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        value = batch.column("value").to_numpy().view(np.uint64)
        for without, cell, of in grid_cells(value):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(of), without, np.int8)), pa.array(cell.view(np.int64)), pa.array(of.view(np.int64))], ["without", "cell", "value"]
            )


_MET = "without tinyint, cell bigint, a bigint, b bigint"


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64))


class _Joined:
    """Which fingerprints the links of a task have joined so far."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def root(self, x: int) -> int:
        above = self.above
        while (up := above.get(x, x)) != x:
            above[x] = x = above.get(up, up)
        return x

    def join(self, a: int, b: int) -> bool:
        """Whether the two were apart."""
        a, b = self.root(a), self.root(b)
        self.above[a] = b
        return a != b


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by cell and fingerprint: links (a < b), and the rows that share their cell (a = b).

    A link is left out where other links of the task join its ends already, so a task makes fewer links than it has
    fingerprints.  Rows of a cell that its links make one component are left out too: the second round has nothing
    to do there.  The first and the last cell of a task may go on in another task, so their rows always count as
    sharing; those of a cell that goes on in the next batch count if they share it.
    """
    names = ["without", "cell", "value"]
    held, first, joined = None, None, _Joined()  # the last rows of the last cell so far; the first cell
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        old = 0 if held is None else len(held[0])
        without, cell, value = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
        n = len(cell)
        if first is None:
            first = (without[0], cell[0])
        out = [[], [], [], []]
        shares = np.zeros(n, bool)
        for step in range(1, REACH + 1):
            if n <= step:
                break
            same = (without[step:] == without[:-step]) & (cell[step:] == cell[:-step])
            shares[step:] |= same
            shares[:-step] |= same
            same[: max(0, old - step)] = False  # both rows are old: they have met
            near = np.flatnonzero(same & (_popcount(value[step:] ^ value[:-step]) <= RADIUS))
            pairs = zip(value[near].tolist(), value[near + step].tolist(), strict=True)
            near = near[np.fromiter((joined.join(a, b) for a, b in pairs), bool, len(near))]
            for part, x in zip(out, (without[near], cell[near], value[near], value[near + step]), strict=True):
                part.append(x)
        at_end = (without == without[-1]) & (cell == cell[-1])
        at_start = (without == without[0]) & (cell == cell[0])  # held rows are of this cell
        told = np.flatnonzero(shares & ~at_end & ~at_start)
        if len(told):  # cells that lie in this batch, but those of one component
            starts = np.flatnonzero(np.concatenate(([True], (without[told[1:]] != without[told[:-1]]) | (cell[told[1:]] != cell[told[:-1]]))))
            roots = np.fromiter((joined.root(x) for x in value[told].tolist()), np.int64, len(told))
            mixed = np.minimum.reduceat(roots, starts) != np.maximum.reduceat(roots, starts)
            told = told[np.repeat(mixed, np.diff(np.append(starts, len(told))))]
        # A held row has been told already if it shared its cell then; telling it again does no harm.
        border = (at_start | at_end) & (shares | ((without == first[0]) & (cell == first[1])))
        told = np.concatenate((told, np.flatnonzero(border)))
        for part, x in zip(out, (without[told], cell[told], value[told], value[told]), strict=True):
            part.append(x)
        arrays = [pa.array(np.concatenate(p), t) for p, t in zip(out, (pa.int8(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["without", "cell", "a", "b"])
        held = [x[at_end][-REACH:] for x in (without, cell, value)]
    if held is not None:
        without, cell, value = held
        yield pa.RecordBatch.from_arrays([pa.array(without, pa.int8()), *(pa.array(x, pa.int64()) for x in (cell, value, value))], ["without", "cell", "a", "b"])


def linked_fingerprints(distinct: DataFrame, workspace: Workspace) -> DataFrame:
    """``node, component`` of every fingerprint (column ``value``, each once) that has a link; exact."""
    # About a hundred rows come of each.
    cells = distinct.repartition(1 + distinct.count() // PER_TASK).mapInArrow(_cells, _CELL)
    order = ["without", "cell", "value"]
    met = workspace.write(cells.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_neighbours, _MET), "neighbours")
    found = components(met.filter("a <> b").select("a", "b").distinct(), workspace)

    shared = met.filter("a = b").select("without", "cell", F.col("a").alias("value")).distinct()
    label = F.coalesce("component", "value").alias("component")
    shared = workspace.write(shared.join(found, F.col("value") == F.col("node"), "left").select("without", "cell", "value", label), "shared")
    # Cells with several components, and the largest of each; ties go to the smallest.
    sizes = shared.groupBy("without", "cell", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = workspace.write(
        sizes.groupBy("without", "cell").agg(F.count(F.lit(1)).alias("of"), F.max_by("component", F.struct("n", F.bitwise_not("component"))).alias("largest"))
        .filter("of > 1").drop("of"),
        "mixed",
    )
    rows = workspace.write(shared.join(mixed, ["without", "cell"]), "rows")
    few = rows.filter("component <> largest").select("without", "cell", F.col("value").alias("a"), F.col("component").alias("of_a"))
    every = rows.select("without", "cell", F.col("value").alias("b"), F.col("component").alias("of_b"))
    apart = (F.col("of_a") != F.col("of_b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)
    more = workspace.write(few.join(every, ["without", "cell"]).filter(apart).select("a", "b").distinct(), "more")
    if more.isEmpty():
        return found
    stars = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(stars.unionByName(more), workspace)


def similar_documents(docs: DataFrame, workspace: Workspace) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row; component_id is the smallest doc_id of the component."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    prints = workspace.write(docs.select("doc_id", "text").mapInArrow(_fingerprints, f"doc_id {kind}, fingerprint bigint"), "fingerprints")
    classes = workspace.write(prints.groupBy(F.col("fingerprint").alias("value")).agg(F.min("doc_id").alias("least")), "classes")
    found = linked_fingerprints(classes.select("value"), workspace)
    labelled = classes.join(found, F.col("value") == F.col("node"), "left").select("value", "least", F.coalesce("component", "value").alias("component"))
    labelled = workspace.write(labelled, "labelled")
    least = labelled.groupBy(F.col("component").alias("of")).agg(F.min("least").alias("component_id"))
    named = workspace.write(labelled.join(least, F.col("component") == F.col("of")).select("value", "component_id"), "named")
    return prints.join(named, F.col("fingerprint") == F.col("value")).select("doc_id", "fingerprint", "component_id")


def simhash_digest(docs: DataFrame, workspace: Workspace) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id``."""
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return similar_documents(docs, workspace).select("doc_id", digits, "component_id")
