import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

import palisade.llm.simhash as simhash
from palisade.llm.simhash import BANDS, fingerprint, grid_cells, linked_fingerprints, simhash_digest
from palisade.llm.tables import Workspace
from tests.conftest import TEST_DATA


def plain(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0d]+", text)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(values):
    """The smallest value that each reaches; every pair is compared."""
    values = sorted(set(values))
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 4:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {v: root(v) for v in values}


def brute(rows):
    prints = [plain(t) for _, t in rows]
    of = linked(prints)
    least = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            least[of[p]] = min(i, least.get(of[p], i))
    return sorted(((i, f"{p:016x}", least.get(of[p])) for (i, _), p in zip(rows, prints, strict=True)), key=str)


def run(spark, rows):
    docs = spark.createDataFrame([(*r, 1, 2, "z") for r in rows], "doc_id bigint, text string, value int, component bigint, cell string")
    return sorted((tuple(r) for r in simhash_digest(docs, Workspace(spark, "test")).collect()), key=str)


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{TEST_DATA}/documents.parquet")
    got = sorted((tuple(r) for r in simhash_digest(docs, Workspace(spark, "test")).collect()), key=str)
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert got == want and len({r[2] for r in got}) < len(got)


def test_odd_texts(spark):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    texts = [None, "", " \t\n\x0b\x0c\r", "one", "ONE", "a b c", "a  b\tc\n", "a b c d", "a b c d e", "É ü A\x00b \x1c x y z", long, long + " end", "a b c d"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "one"), (3, "other words in here"), (None, "one"), (None, "alone again here now"), (-7, "A B C D")]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("text", ["x", "a b c d e f", "repeat " * 50, "Zoë\x0bzoë zoË", " lead and trail "])
def test_fingerprint(text):
    assert fingerprint(text.encode()) & (2**64 - 1) == plain(text)


def signed(v):
    return v - 2**64 if v >> 63 else v


def flipped(draw, value, n):
    for b in draw.sample(range(64), n):
        value ^= 1 << b
    return value


def values_around(centres, each, most, seed):
    draw = random.Random(seed)
    out = {0, 2**64 - 1, 2**63, 1, 0x8000000000000001, 0xAAAAAAAAAAAAAAAA, 0x5555555555555555}
    for _ in range(centres):
        c = draw.getrandbits(64)
        out |= {c} | {flipped(draw, c, draw.randint(1, most)) for _ in range(each)}
    return [signed(v) for v in out]


@pytest.mark.parametrize(("centres", "each", "most", "reach"), [(40, 12, 6, 4), (3, 250, 4, 1), (2, 300, 9, 2), (1, 400, 14, 1)])
def test_links_equal_brute_force(spark, monkeypatch, centres, each, most, reach):
    """Dense groups too, in which the neighbours of the first round leave many links to the second."""
    monkeypatch.setattr(simhash, "REACH", reach)
    values = values_around(centres, each, most, seed=centres)
    distinct = spark.createDataFrame([(v,) for v in values], "value bigint").repartition(7)
    found = {r.node: r.component for r in linked_fingerprints(distinct, Workspace(spark, "test")).collect()}
    assert {v: found.get(v, v) for v in values} == linked(values)


def cells(value):
    return {(without, int(c)) for without, cell, _ in grid_cells(np.array([value], np.uint64)) for c in cell}


def test_linked_values_share_a_cell():
    draw = random.Random(9)
    pairs = []
    for _ in range(400):
        v = draw.choice([draw.getrandbits(64), 0, 2**64 - 1])
        pairs.append((v, flipped(draw, v, draw.randint(1, 4))))
    # The worst case: the differing bits lie in three bands, in different segments.
    for v in (0, 2**64 - 1):
        for bands in ((0, 0, 1, 2), (0, 1, 1, 2), (0, 1, 2, 2)):
            seen = [0, 0, 0]
            w = v
            for b in bands:
                w ^= 1 << 2 * (BANDS[b][0] + seen[b])
                seen[b] += 1
            pairs.append((v, w))
    assert all(cells(a) & cells(b) for a, b in pairs)


@pytest.mark.parametrize("size", [7, 50, 1000])
def test_a_cell_of_near_copies_makes_fewer_links_than_rows(size):
    """Cells 1 and 9 are a task's first and last; 2 and 3 hold near copies, 4 two groups that are apart."""
    base = 0x0123456789ABCDEF
    near = sorted({base ^ 1 << i ^ 1 << j for i in range(12) for j in range(i)} | {base ^ 1 << i for i in range(12)})
    far = [v ^ 0x7FFF << 40 for v in near[:5]]
    rows = [(1, 5)] + [(c, v) for c in (2, 3) for v in near] + [(4, v) for v in sorted(near[:5] + far)] + [(9, 7)]
    table = pa.table({"without": pa.array([0] * len(rows), pa.int8()), "cell": [c for c, _ in rows], "value": [v for _, v in rows]})
    out = pa.Table.from_batches(simhash._neighbours(iter(table.to_batches(max_chunksize=size)))).to_pylist()
    links = [(r["a"], r["b"]) for r in out if r["a"] != r["b"]]
    of = {}
    for a, b in links:
        of.setdefault(a, {a}).update(of.setdefault(b, {b}))
        for v in of[a]:
            of[v] = of[a]
    assert set(near) <= of[near[0]] and of[far[0]] == set(far) and len(links) == len(near) + len(far) - 2
    told = {(r["cell"], r["a"]) for r in out if r["a"] == r["b"]}
    assert {v for c, v in told if c == 4} == set(near[:5] + far) and {(1, 5), (9, 7)} <= told
    if size == 1000:
        assert not [t for t in told if t[0] in (2, 3)]
