import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest

import palisade.llm.near as near
from palisade.llm.graph import components
from palisade.llm.near import crowded_pairs, near_digest
from palisade.llm.tables import Workspace
from tests.conftest import TEST_DATA


def shingles(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall("[^\x20\x09-\x0d]+", text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """Rows in key order; every pair that shares a shingle is compared."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        seen = defaultdict(int)
        for x in s:
            for j in holders[x]:
                seen[j] += 1
            holders[x].append(i)
        for j, both in seen.items():
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return sorted(((rows[i][0], len(sets[i]), rows[root(i)][0], root(i) == i) for i in range(len(rows))), key=str)


def run(spark, rows):
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, a int, component bigint")
    return sorted((tuple(r) for r in near_digest(docs, Workspace(spark, "test")).collect()), key=str)


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{TEST_DATA}/documents.parquet")
    got = sorted((tuple(r) for r in near_digest(docs, Workspace(spark, "test")).collect()), key=str)
    assert got == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])


def copies(n, words, edits, seed, first):
    draw = random.Random(seed)
    base = [f"w{draw.randrange(10**6)}" for _ in range(words)]
    out = []
    for i in range(n):
        text = list(base)
        for _ in range(edits):
            text[draw.randrange(words)] = f"e{draw.randrange(10**6)}"
        out.append((first + i, " ".join(text)))
    return out


def test_large_group_and_odd_rows(spark):
    rows = copies(700, 150, 2, 1, 1000) + copies(6, 40, 1, 2, 10) + [
        (1, None), (2, ""), (3, " \n"), (4, "one Two"), (5, "one two"), (6, "two one"), (None, "a b c d e f"), (None, "a b c d e F"),
        (7, "a b c d e f"), (7, "q"), (8, "x " * 100_000), (9, "y\x0bx\tx x x x x")]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(5, "alone")]])
def test_few_rows(spark, rows):
    assert run(spark, rows) == brute(rows)


def crowd(n, pairs, seed):
    """Texts of one template that are not similar, the first ones each with a similar one."""
    draw = random.Random(seed)
    base = [f"w{i}" for i in range(120)]

    def own(words, part):
        return words[: 120 - part] + [f"o{draw.randrange(10**9)}" for _ in range(part)]

    texts = [own(base, draw.randrange(20, 23)) for _ in range(n)]
    texts += [own(t, 15) for t in texts[:pairs]]
    keys = draw.sample(range(10**6), len(texts))
    return [(k, " ".join(t)) for k, t in zip(keys, texts, strict=True)]


def test_crowded_template(spark, monkeypatch):
    rows = crowd(300, 60, 5)
    monkeypatch.setattr(near, "REACH", 1)
    want = brute(rows)
    assert sum(not kept for *_, kept in want) == 60
    assert run(spark, rows) == want


def test_blocks_hold_every_similar_pair(spark):
    rows = sorted(crowd(150, 40, 6) + copies(60, 150, 2, 1, 2 * 10**6))
    x, first = near.shingle_sets([t.encode() for _, t in rows])
    sets = [set(x[a:b].tolist()) for a, b in zip(first, first[1:], strict=False)]
    want = {(rows[i][0], rows[j][0]) for j in range(len(sets)) for i in range(j) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    table = [(k, k, bytearray(np.sort(x[first[i] : first[i + 1]]).tobytes())) for i, (k, _) in enumerate(rows)]
    docs = spark.createDataFrame(table, "doc_key bigint, component bigint, shingles binary")
    for block in (7, 1000):
        got = {tuple(r) for r in crowded_pairs(docs, Workspace(spark, "test"), block=block).collect()}
        assert got >= want and len(want) > 100


def test_sketches_lose_no_more_than_the_forest():
    n, chance = near.TREES * near.DEPTH, 1 / (1 << near.NIBBLE)
    p = 0.75 + 0.25 * chance
    refused = [k for k in range(n + 1) if (k / n - chance) / (1 - chance) < near.DOUBTFUL]
    assert sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in refused) < 3e-9


def test_components(spark, monkeypatch):
    import palisade.llm.graph as graph

    monkeypatch.setattr(graph, "LINKS_PER_TASK", 40)
    draw = random.Random(3)
    order = draw.sample(range(1000, 2000), 120)
    links = list(zip(order, order[1:], strict=False)) + [(7, i) for i in range(8, 60)] + [(3, 3), (70, 71), (71, 70)]
    draw.shuffle(links)
    got = dict(components(spark.createDataFrame(links, "a bigint, b bigint"), Workspace(spark, "test")).collect())
    want = {x: min(order) for x in order} | dict.fromkeys(range(7, 60), 7) | {70: 70, 71: 70}
    assert got == want
