"""Removing repeated passages by longest-previous-factor arrays over suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier in the corpus (in a smaller
document, or earlier in the same one).  One suffix array of a corpus does not fit a task, so suffixes are
first brought together by content:

1. Every window of ``LENGTH`` bytes has an anchor, the k-gram in it with the smallest hash (the leftmost
   of equals).  Equal windows have equal anchors at equal places.  Successive windows of one anchor form
   a segment: one row per 35 bytes or so, with a hash of the anchor and one of the whole segment.
2. Anchors that occur once are done: nothing there repeats.  Where all segments of an anchor are equal,
   all but the first are repeats throughout.
3. Where the segments of an anchor differ, their first occurrences (the variants) go to tasks by anchor.
   A task sorts the suffixes of its variants, which lie in corpus order, and computes for each suffix
   the longest factor that starts earlier, from the previous and next smaller positions in suffix order.
   Where it reaches ``LENGTH``, the window is a repeat.
4. An anchor of more than ``HEAVY`` variants (a line that very many documents have, in as many contexts) is
   not brought to one task: its windows are ordered by content across tasks, cut after ``LENGTH`` bytes,
   and all but the first of equal ones are repeats.
5. Documents meet their repeated windows and are cut.

All shuffles but those of texts carry rows of a few numbers.  Frequent segments and windows are combined
before they are shuffled, and looked up in written tables by joins that Spark may split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.llm.bytewords import _BASE, _BASE_INVERSE, _VALUE, mix, powers
from palisade.llm.tables import Workspace, slices, with_key

LENGTH = 100
GRAM = 24
HEAVY = 8000  # of at most 176 bytes: 1.4 MB of suffixes, about 150 MB of arrays in a task
PLACE_BITS = 28  # of a byte in its document; a key of 35 bits stands above
_CHUNK = 1 << 20
_BATCH_BYTES = 1 << 19
_OTHER = np.random.default_rng(43).integers(1, 1 << 63, 256, dtype=np.uint64)


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the strings of ``size`` bytes from each place on, by doubling."""
    power, width, out, done = _VALUE[data], 1, None, 0
    base = np.uint64(_BASE)
    scale = base
    while True:
        if size & width:
            if out is None:
                out = power
            else:  # what is done so far, followed by this power of two
                n = min(len(out), len(power) - done)
                out = out[:n] * scale + power[done : done + n]
            done += width
        if done == size:
            return mix(out[: len(data) - size + 1])
        power = power[:-width] * scale + power[width:]
        scale, width = scale * scale, 2 * width


def _sliding_minimum(x: np.ndarray, size: int) -> np.ndarray:
    width = 1
    while 2 * width <= size:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    rest = size - width
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


class _Hashes:
    """Hashes of any parts of a byte string."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_OTHER[data] * powers(len(data), _BASE_INVERSE), out=self.sums[1:])
        self.up = powers(len(data) + 1, _BASE)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.up[start] + (end - start).astype(np.uint64))


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Segments of the texts: anchor hash, segment hash, text, first window, number of windows."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.cumsum(sizes) - sizes
    empty = np.empty(0, np.int64)
    if len(data) < LENGTH or sizes.max(initial=0) < LENGTH:
        return empty, empty, empty, empty, empty
    grams = _gram_hashes(data, GRAM)
    places = np.uint64((1 << PLACE_BITS) - 1)
    keyed = (grams & ~places) | np.arange(len(grams), dtype=np.uint64)
    at = (_sliding_minimum(keyed, LENGTH - GRAM + 1) & places).astype(np.int64)
    windows = np.maximum(sizes - LENGTH + 1, 0)
    text = np.repeat(np.arange(len(texts)), windows)
    start = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows) + begin[text]
    at = at[start]
    new = np.concatenate(([True], (np.diff(start) != 1) | (np.diff(at) != 0)))
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(start)))
    low, anchor = start[first], at[first]
    whole = _Hashes(data)(low, low + n + LENGTH - 1) + mix((anchor - low).astype(np.uint64))
    return grams[anchor].view(np.int64), whole.view(np.int64), text[first], low - begin[text[first]], n


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(iter([batch]), "text", _CHUNK):
            key = part.column("doc_key").to_numpy()
            anchor, whole, text, low, n = anchors([(t or "").encode() for t in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(whole), pa.array((key[text] << PLACE_BITS) | low), pa.array(n, pa.int32())],
                                             ["anchor", "whole", "place", "n"])


# --- suffix arrays --------------------------------------------------------------------------------


def suffix_ranks(data: np.ndarray, levels: int = 7) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4 ... bytes (prefix doubling); beyond the end counts as -1."""
    ranks = [data.astype(np.int64)]
    for level in range(1, levels):
        step = 1 << (level - 1)
        last = ranks[-1]
        ahead = np.full(len(last), -1, np.int64)
        ahead[:-step] = last[step:]
        if level == 1:
            ranks.append((last + 1) << 9 | (ahead + 1))
        else:
            ranks.append(np.unique((last + 1) << 32 | (ahead + 1), return_inverse=True)[1])
    return ranks


def common_prefix(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many bytes the suffixes i and j share, up to twice the last level."""
    out = np.zeros(len(i), np.int64)
    n = len(ranks[0])
    for level in range(len(ranks) - 1, -1, -1):
        a, b = np.minimum(i + out, n - 1), np.minimum(j + out, n - 1)
        same = (ranks[level][a] == ranks[level][b]) & (np.maximum(i, j) + out < n)
        out += same * (1 << level)
    return out


def _nearest_smaller(x: np.ndarray) -> np.ndarray:
    """For each place the nearest place before it with a smaller value, or -1; by pointer jumping."""
    out = np.arange(-1, len(x) - 1)
    todo = np.flatnonzero(out >= 0)
    while True:
        todo = todo[x[out[todo]] > x[todo]]
        if not len(todo):
            return out
        out[todo] = out[out[todo]]  # whatever is larger than x here and before its own smaller one is skipped
        todo = todo[out[todo] >= 0]


def longest_previous_factors(data: np.ndarray, order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """For the suffixes in ``order`` (sorted, ties by position): the longest factor that starts earlier."""
    before, after = _nearest_smaller(order), len(order) - 1 - _nearest_smaller(order[::-1])[::-1]
    out = np.zeros(len(order), np.int64)
    for near, there in ((before, before >= 0), (after, after < len(order))):
        i = np.flatnonzero(there)
        out[i] = np.maximum(out[i], common_prefix(ranks, order[i], order[near[i]]))
    return out


def repeated_windows(segments: list[bytes]) -> list[np.ndarray]:
    """Of segments in corpus order, the starts of windows that also start in an earlier place."""
    sizes = np.fromiter(map(len, segments), np.int64, len(segments))
    data = np.frombuffer(b"".join(segments), np.uint8)
    ranks = suffix_ranks(data)
    begin = np.cumsum(sizes) - sizes
    windows = sizes - LENGTH + 1
    of = np.repeat(np.arange(len(segments)), windows)
    start = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows) + begin[of]
    tail = ranks[-1]  # the first 64 bytes, then the 64 that end the window
    order = start[np.lexsort((start, tail[start + LENGTH - 64], tail[start]))]
    hit = np.sort(order[longest_previous_factors(data, order, ranks) >= LENGTH])
    of = np.searchsorted(begin, hit, "right") - 1
    cut = np.searchsorted(of, np.arange(len(segments) + 1))
    return [hit[a:b] - begin[i] for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True))]


def _runs(place: np.ndarray, hits: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Successive windows as (place of the first, how many)."""
    at = np.concatenate([p + h for p, h in zip(place.tolist(), hits, strict=True)]) if len(place) else np.empty(0, np.int64)
    new = np.ones(len(at), bool)
    new[1:] = np.diff(at) != 1
    first = np.flatnonzero(new)
    return at[first], np.diff(np.append(first, len(at)))


def _by_suffix_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by anchor; whole anchors are sorted together, many at a time."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def found() -> pa.RecordBatch:
        held.sort(key=lambda x: x[1])  # corpus order
        at, n = _runs(np.array([p for _, p, _ in held], np.int64), repeated_windows([d for _, _, d in held]))
        return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n, pa.int64())], ["place", "n"])

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "place", "data")), strict=True):
            if size > _BATCH_BYTES and row[0] != held[-1][0]:
                yield found()
                held.clear()
                size = 0
            held.append(row)
            size += len(row[2])
    if held:
        yield found()


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """128 bits that stand for each window's content, and its place."""
    for batch in batches:
        for part in slices(iter([batch]), "data", _BATCH_BYTES):
            segments = part.column("data").to_pylist()
            sizes = np.fromiter(map(len, segments), np.int64, len(segments))
            data = np.frombuffer(b"".join(segments), np.uint8)
            n, begin = sizes - LENGTH + 1, np.cumsum(sizes) - sizes
            of = np.repeat(np.arange(len(n)), n)
            inner = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            start = begin[of] + inner
            one, two = _gram_hashes(data, LENGTH)[start], _Hashes(data)(start, start + LENGTH)
            yield pa.RecordBatch.from_arrays(
                [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(part.column("place").to_numpy()[of] + inner)],
                ["one", "two", "place"],
            )


def repeated_places(keyed: DataFrame, workspace: Workspace, *, heavy: int = HEAVY) -> DataFrame:
    """``doc_key, runs`` of documents with repeats: runs of repeated windows as (low, n), not sorted."""
    segments = keyed.select("doc_key", "text").mapInArrow(_segments, "anchor bigint, whole bigint, place bigint, n int")
    repeated = workspace.write(
        segments.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("times"), F.min("whole").alias("a"), F.max("whole").alias("b"), F.min("place").alias("first"))
        .filter("times > 1").select("anchor", F.expr("a <> b").alias("many"), "first"),
        "repeated-anchors",
    )
    met = workspace.write(
        segments.join(repeated, "anchor").filter("many OR place <> first").select("anchor", "whole", "place", "n", "many"), "segments"
    )
    workspace.remove(repeated)
    several = met.filter("many")
    variants = workspace.write(several.groupBy("anchor", "whole").agg(F.min("place").alias("first"), F.max("n").alias("n")), "variants")
    later = several.join(variants.drop("n"), ["anchor", "whole"]).filter("place <> first")
    whole = met.filter("NOT many").select("place", "n").unionByName(later.select("place", "n"))

    crowded = workspace.write(variants.groupBy("anchor").count().filter(F.col("count") > heavy).select("anchor", F.lit(True).alias("heavy")), "heavy")
    low = (1 << PLACE_BITS) - 1
    asked = workspace.write(
        variants.join(crowded, "anchor", "left").groupBy(F.shiftright("first", PLACE_BITS).alias("of")).agg(
            F.collect_list(F.struct("anchor", F.col("first").alias("place"), "n", F.coalesce("heavy", F.lit(False)).alias("heavy"))).alias("asked")
        ),
        "asked",
    )

    def cut(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(iter([batch]), "text", _CHUNK):
                out = []
                for text, rows in zip(part.column("text").to_pylist(), part.column("asked").to_pylist(), strict=True):
                    data = (text or "").encode()
                    for r in rows:
                        at = r["place"] & low
                        out.append((r["anchor"], r["heavy"], r["place"], data[at : at + r["n"] + LENGTH - 1]))
                columns = list(zip(*out, strict=True)) if out else [(), (), (), ()]
                kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["anchor", "heavy", "place", "data"])

    texts = keyed.select("doc_key", "text").join(asked, F.col("doc_key") == F.col("of")).select("text", "asked")
    data = workspace.write(texts.mapInArrow(cut, "anchor bigint, heavy boolean, place bigint, data binary"), "variant-texts")
    light = data.filter("NOT heavy").select("anchor", "place", "data").repartition("anchor").sortWithinPartitions("anchor", "place")
    light = light.mapInArrow(_by_suffix_arrays, "place bigint, n bigint")
    windows = data.filter("heavy").select("place", "data").mapInArrow(_windows, "one bigint, two bigint, place bigint")
    first = workspace.write(windows.groupBy("one", "two").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1"), "first-windows")
    crowd = windows.join(first, ["one", "two"]).filter("place <> first").select("place", F.lit(1).cast("long").alias("n"))

    runs = whole.unionByName(light).unionByName(crowd)
    out = workspace.write(
        runs.groupBy(F.shiftright("place", PLACE_BITS).alias("doc_key")).agg(
            F.collect_list(F.struct(F.col("place").bitwiseAND(low).cast("int").alias("low"), F.col("n").cast("int").alias("n"))).alias("runs")
        ),
        "runs",
    )
    for table in (met, variants, asked, data):
        workspace.remove(table)
    return out


def without_repeats(text: bytes, runs: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left of a text, and how many bytes and stretches go."""
    kept, at, removed, stretches, reach = [], 0, 0, 0, -1
    for low, n in sorted(runs):
        end = low + n + LENGTH - 1
        if low > reach:
            stretches += 1
            kept.append(text[at:low])
        if end > reach:
            removed += end - max(low, reach)
            at = reach = end
    kept.append(text[at:])
    return b"".join(kept), removed, stretches


def repeats_digest(docs: DataFrame, workspace: Workspace, **settings) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document row.

    Texts are judged as they are in the input, as UTF-8; null counts as empty.  The order of documents is
    that of doc_id, null first; rows that share a doc_id follow each other in the order of their texts.
    """
    keyed = with_key(docs, workspace)
    runs = repeated_places(keyed, workspace, **settings).withColumnRenamed("doc_key", "of")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(iter([batch]), "text", _CHUNK):
                sizes, gone, spans, shas = [], [], [], []
                for text, found in zip(part.column("text").to_pylist(), part.column("runs").to_pylist(), strict=True):
                    data = (text or "").encode()
                    kept, removed, stretches = without_repeats(data, [(r["low"], r["n"]) for r in found or ()])
                    sizes.append(len(data))
                    gone.append(removed)
                    spans.append(stretches)
                    shas.append(hashlib.sha256(kept).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(x, pa.int64()) for x in (sizes, gone, spans)), pa.array(shas, pa.string())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
                )

    return keyed.join(runs, F.col("doc_key") == F.col("of"), "left").select("doc_id", "text", "runs").mapInArrow(
        digest, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    )
