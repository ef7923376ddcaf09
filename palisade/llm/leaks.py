"""Benchmark decontamination with suffix arrays over the training texts.

Every batch of documents is a shard.  The words of a shard are hashed, and the suffixes (word
positions) that can begin a benchmark window are sorted by their first ``WINDOW`` words: the shard's
suffix array, without the suffixes that no test suffix can meet.  Equal windows of the benchmark are
one class; each is binary-searched in the shard once, however many items share it, so a document has
at most one hit per word and window size.

The benchmark has a suffix array too, over the classes of its windows.  From the first hit word on, the
interval of test suffixes that agree with the document is narrowed class by class until none is left:
the longest passage that some item holds verbatim, and one place of it.  The next match begins at the
first hit window after.  The items of a document are those of the classes that it hits.

Documents are read once and not shuffled: the benchmark is the stated query set.  It goes to the tasks
in blocks of at most ``BLOCK_BYTES`` of text; a larger one is searched block by block, and the matches
of a document are joined afterwards.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.llm.bytewords import ALPHANUMERIC, mix, words
from palisade.llm.tables import Workspace, slices, with_key

WINDOW = 10
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 2 << 20
_SEED = 3  # words of a suffix that the first filter looks at
_FILTER_BITS = 22


@dataclass
class TestSuffixes:
    """Windows of benchmark items by class of equal ones, and the suffix array over the classes."""

    ids: list[str]
    keys: np.ndarray  # of each class: big-endian word hashes, WINDOW of them, zero beyond the window
    size: np.ndarray  # of each class: words
    kind: np.ndarray  # of each window: its class
    item: np.ndarray  # of each window: its item
    place: np.ndarray  # of each window: the word at which it starts in its item
    order: np.ndarray  # windows sorted by the classes from there to the end of the item
    low: np.ndarray  # where a class begins in ``order``, and the end
    holders: np.ndarray  # items of class 0, of class 1, ...
    holders_low: np.ndarray
    seeds: dict[int, np.ndarray]  # filter of the first words, by how many of them

    def ahead(self, window: int, n: int) -> int:
        """The class n windows later in the same item, -1 beyond its end."""
        at = window + n
        return self.kind[at] if at < len(self.kind) and self.item[at] == self.item[window] else -1

    def passages(self, starts: list[int], kinds: list[int]) -> list[tuple[int, int, int, int]]:
        """(first word, item, first word in the item, words) of the windows found in a text, in order of their words."""
        out = [(s, k) for s, k in zip(starts, kinds, strict=True) if self.size[k] < WINDOW]
        out = [(s, self.order[self.low[k]], self.size[k]) for s, k in out]
        full = [(s, k) for s, k in zip(starts, kinds, strict=True) if self.size[k] == WINDOW]
        i = 0
        while i < len(full):
            start, kind = full[i]
            low, high, n = self.low[kind], self.low[kind + 1], 1
            while i + n < len(full) and full[i + n][0] == start + n:
                low, high = self._narrow(low, high, n, full[i + n][1])
                if low < 0:
                    break
                found, n = low, n + 1
            out.append((start, self.order[self.low[kind] if n == 1 else found], WINDOW + n - 1))
            i += n
        return sorted((int(s), int(self.item[w]), int(self.place[w]), int(words)) for s, w, words in out)

    def _narrow(self, low: int, high: int, n: int, kind: int) -> tuple[int, int]:
        """The part of an interval of ``order`` whose suffixes go on with a class, or (-1, -1)."""
        if high - low == 1:
            return (low, high) if self.ahead(self.order[low], n) == kind else (-1, -1)
        low = bisect_left(self.order, kind, low, high, key=lambda w: self.ahead(w, n))
        high = bisect_right(self.order, kind, low, high, key=lambda w: self.ahead(w, n))
        return (low, high) if low < high else (-1, -1)

    def items_of(self, kinds: np.ndarray) -> list[str]:
        met = {i for k in np.unique(kinds) for i in self.holders[self.holders_low[k] : self.holders_low[k + 1]].tolist()}
        return sorted({self.ids[i] for i in met})


def suffix_order(kind: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Windows sorted by the classes from there to the end of their item, by prefix doubling."""
    rank, step, n = kind.astype(np.int64), 1, len(kind)
    while True:
        ahead = np.full(n, -1)
        ahead[: n - step] = np.where(item[step:] == item[: n - step], rank[step:], -1)
        order = np.lexsort((ahead, rank))
        new = np.empty(n, np.int64)
        new[order] = np.cumsum((np.diff(rank[order], prepend=rank[order[:1]]) != 0) | (np.diff(ahead[order], prepend=ahead[order[:1]]) != 0))
        if n == 0 or step >= n or new.max() == rank.max():
            return order
        rank, step = new, 2 * step


def _rows_of(hashes: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The suffixes at some words as byte strings of fixed width; words beyond the text are zero."""
    columns = np.arange(WINDOW)
    rows = hashes[np.minimum(at[:, None] + columns, len(hashes) - 1)]
    rows = np.where(columns < left[:, None], rows, 0).astype(">u8")
    return np.ascontiguousarray(rows).view(f"S{8 * WINDOW}").ravel()


def _seed(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of n words from each position on (the last n - 1 positions have none)."""
    out = hashes[: len(hashes) - n + 1].copy()
    for i in range(1, n):
        out = mix(out + hashes[i : len(hashes) - n + 1 + i])
    return (out >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


def suffixes_of(items: list[tuple[str, str | None]]) -> TestSuffixes:
    found = words([(text or "").encode() for _, text in items], ALPHANUMERIC)
    count = np.diff(found.first)
    size = np.minimum(count, WINDOW)
    windows = np.where(count > 0, count - size + 1, 0)
    item = np.repeat(np.arange(len(items)), windows)
    place = np.arange(len(item)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = found.first[item] + place
    keys = _rows_of(found.hash, at, size[item]) if len(item) else np.empty(0, f"S{8 * WINDOW}")
    keys, first, kind = np.unique(keys, return_index=True, return_inverse=True)
    order, every = suffix_order(kind, item), np.arange(len(keys) + 1)
    held = np.unique(np.stack([kind, item], axis=1), axis=0).reshape(-1, 2)
    seeds = {}
    for n in range(1, _SEED + 1):
        mine = at[size[item] == n] if n < _SEED else at[size[item] >= n]
        if len(mine):
            seeds[n] = np.zeros(1 << _FILTER_BITS, bool)
            seeds[n][_seed(found.hash, n)[mine]] = True
    return TestSuffixes(
        [i for i, _ in items], keys, size[item][first], kind, item, place, order, np.searchsorted(kind[order], every),
        held[:, 1], np.searchsorted(held[:, 0], every), seeds,
    )


def search_shard(texts: list[bytes], tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray]:
    """Words per text, and rows (text, first word, class) of all windows found, sorted."""
    found = words(texts, ALPHANUMERIC)
    counts = np.diff(found.first)
    wanted = np.zeros(len(found.hash), bool)
    for n, seeds in tests.seeds.items():
        if len(wanted) >= n:
            wanted[: len(wanted) - n + 1] |= seeds[_seed(found.hash, n)]
    at = np.flatnonzero(wanted)
    if not len(at):
        return counts, np.empty((0, 3), np.int64)
    left = found.first[found.text[at] + 1] - at
    keys = _rows_of(found.hash, at, left)
    order = np.argsort(keys, kind="stable")  # the suffix array
    keys, at = keys[order], at[order]
    low = np.searchsorted(keys, tests.keys, "left")
    # The end of the suffixes that begin with a test suffix: nothing between the two has other first words.
    top = np.frombuffer(tests.keys.tobytes(), np.uint8).reshape(-1, 8 * WINDOW).copy()
    top[np.arange(8 * WINDOW) >= 8 * tests.size[:, None]] = 0xFF
    high = np.searchsorted(keys, np.ascontiguousarray(top).view(f"S{8 * WINDOW}").ravel(), "right")
    n = high - low
    test = np.repeat(np.arange(len(n)), n)
    hit = at[np.arange(len(test)) - np.repeat(np.cumsum(n) - n, n) + low[test]]
    text = found.text[hit]
    inside = hit + tests.size[test] <= found.first[text + 1]
    rows = np.stack([text, hit - found.first[text], test], axis=1)[inside]
    return counts, rows[np.lexsort(rows.T[::-1])]


_SPAN = pa.struct([("start", pa.int32()), ("item_id", pa.string()), ("item_start", pa.int32()), ("words", pa.int32())])


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[str, str | None]]]:
    rows, held = [], 0
    for item_id, text in benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), "text").toLocalIterator():
        size = len((text or "").encode())
        if rows and held + size > limit:
            yield rows
            rows, held = [], 0
        rows.append((item_id, text))
        held += size
    yield rows


def _search(docs: DataFrame, tests: TestSuffixes) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(tests)  # of at most one block of the benchmark

    def matches(batches):
        for batch in batches:
            for part in slices(iter([batch]), "text", SHARD_BYTES):
                texts = [(t or "").encode() for t in part.column("text").to_pylist()]
                counts, rows = search_shard(texts, shared.value)
                bounds = np.searchsorted(rows[:, 0], np.arange(len(texts) + 1))
                spans, items = [[] for _ in texts], [[] for _ in texts]
                for i in np.flatnonzero(np.diff(bounds)).tolist():
                    _, starts, kinds = rows[bounds[i] : bounds[i + 1]].T
                    found = shared.value.passages(starts.tolist(), kinds.tolist())
                    spans[i] = [dict(zip(_SPAN.names, (s, shared.value.ids[x], p, n), strict=True)) for s, x, p, n in found]
                    items[i] = shared.value.items_of(kinds)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_key"), part.column("doc_id"), pa.array(counts, pa.int64()),
                     pa.array(spans, pa.list_(_SPAN)), pa.array(items, pa.list_(pa.string()))],
                    ["doc_key", "doc_id", "n_words", "matches", "items"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(matches, f"doc_key bigint, doc_id {kind}, n_words bigint, "
                           "matches array<struct<start: int, item_id: string, item_start: int, words: int>>, items array<string>")  # fmt: skip


def find_leaks(docs: DataFrame, benchmark: DataFrame, workspace: Workspace, *, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_key, doc_id, n_words, matches, items``: per document row its verbatim matches with the benchmark.

    A match is (start, item_id, item_start, words), counted in words: from the first hit window that no
    match before it holds, the longest passage that one item holds too, and one of its places there.
    ``items`` are all items of which a window occurs.  Null and empty texts have no
    words, an item without words has no window, a null item_id is written ``null``, and items that
    repeat an id share it.  Without items nothing matches; an empty table gives no rows.
    """
    keyed = with_key(docs, workspace)
    found = [_search(keyed, suffixes_of(block)) for block in _blocks(benchmark, block_bytes)]
    if len(found) == 1:
        return found[0]
    out = workspace.write(found[0], "matches")
    for more in found[1:]:
        out = out.unionByName(workspace.write(more, "matches"))
    return out.groupBy("doc_key").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("matches")).alias("matches"),  # a list per block of the benchmark
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )


def leaks_digest(docs: DataFrame, benchmark: DataFrame, workspace: Workspace, **settings) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    found = find_leaks(docs, benchmark, workspace, **settings)

    def digests(batches):
        for batch in batches:
            n_hit, n_items, shas = [], [], []
            for spans, items in zip(batch.column("matches").to_pylist(), batch.column("items").to_pylist(), strict=True):
                covered = reach = 0
                for start, end in sorted((x["start"], x["start"] + x["words"]) for x in spans):
                    covered += max(0, end - max(start, reach))
                    reach = max(reach, end)
                n_hit.append(covered)
                n_items.append(len(items))
                shas.append(hashlib.sha256(",".join(sorted(items)).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array(n_hit, pa.int64()),
                 pa.array(n_items, pa.int64()), pa.array(shas, pa.string()), pa.array([x > 0 for x in n_hit], pa.bool_())],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(digests, f"doc_id {kind}, n_words bigint, n_hit bigint, n_items bigint, "
                            "items_sha256 string, contaminated boolean")  # fmt: skip


def without_leaks(docs: DataFrame, benchmark: DataFrame, workspace: Workspace) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs."""
    packed = with_key(docs.select("doc_id", "text", F.struct(*docs.columns).alias("row")), workspace, extra=("row",))
    found = find_leaks(packed.select(F.col("doc_key").alias("doc_id"), "text"), benchmark, workspace)
    leaky = workspace.write(found.filter(F.size("matches") > 0).select(F.col("doc_key").alias("of")), "leaky")
    return packed.join(leaky, F.col("doc_key") == F.col("of"), "left_anti").select("row.*")


LEAKS_SQL = r"""
WITH item_words AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
windows AS (SELECT item_id, least(len(w), 10) AS size, w[i:i + least(len(w), 10) - 1] AS win
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc_words),
sizes AS (SELECT DISTINCT size FROM windows),
found AS (SELECT p.doc_id, p.i, s.size, v.item_id
  FROM places p CROSS JOIN sizes s JOIN windows v ON v.size = s.size AND p.w[p.i:p.i + s.size - 1] = v.win
  WHERE p.i + s.size - 1 <= len(p.w)),
hits AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS x FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
    array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS ids FROM found GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
  sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hits h ON d.doc_id = h.doc_id LEFT JOIN items i ON d.doc_id = i.doc_id
"""
