import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import palisade.llm.negatives as negatives
from palisade.llm.negatives import hard_negatives, inner_products, negatives_digest
from palisade.llm.tables import Workspace

SCHEMA = "vec_id bigint, embedding array<float>, label int, rank int, row string"


def brute(rows, positives=5, tries=3):
    whole = []
    for i, v, label, *_ in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole.append((i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    out = []
    key = lambda x: (-x[0], x[1] is not None, x[1] or 0)
    for a in whole:
        if a[0] is None or a[0] % 50:
            continue
        scored = [(sum(p * q for p, q in zip(a[1], b[1], strict=False)), b[0], b[2]) for b in whole if b is not a]
        for p in sorted((s for s in scored if s[2] == a[2]), key=key)[:positives]:
            near = sorted((s for s in scored if s[2] != a[2] and 50 * p[0] <= 100 * s[0] <= 95 * p[0]), key=key)[:tries]
            out += [(a[0], p[1], k + 1, s[1], p[0], s[0]) for k, s in enumerate(near)]
    return sorted(out, key=str)


def run(spark, rows):
    vectors = spark.createDataFrame(rows, SCHEMA)
    return sorted((tuple(r) for r in negatives_digest(vectors, Workspace(spark, "test")).collect()), key=str)


def some(n, seed=1, width=8):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 0.4) for _ in range(width)] for _ in range(4)]
    rows = []
    for i in range(n):
        label = draw.randrange(10)
        v = [float(np.float32(c + draw.gauss(0, 0.2))) for c in centres[label % 4]]
        rows.append((i, v, label, 0, "x"))
    return rows


def test_equals_brute_force_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 64)
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    rows = some(500)
    got = run(spark, rows)
    assert got == brute(rows) and len(got) > 50


def test_ties_repeats_nulls_and_odd_vectors(spark):
    rows = some(120, seed=2)
    rows += [(150, rows[0][1], 3, 1, "y")] * 2 + [(200, rows[0][1], 3, 1, "y"), (201, rows[0][1], 3, 1, "y")]
    rows += [(250, None, 1, 0, ""), (300, [], 1, 0, ""), (350, [None, 1.0], 1, 0, ""), (400, [float("nan")], 2, 0, ""), (450, [float("inf")], 2, 0, "")]
    rows += [(500, rows[0][1], None, 0, ""), (None, rows[0][1], 3, 0, ""), (None, rows[1][1], 4, 0, ""), (550, [0.5, -0.25], 5, 0, ""), (-50, rows[2][1], -3, 0, "")]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, [0.5], 1, 0, "")], [(50, [0.5], 1, 0, "")], [(50, None, 1, 0, "")]])
def test_nothing_to_mine(spark, rows):
    assert run(spark, rows) == []


@pytest.mark.parametrize(("low", "high"), [(0, 0), (-3, 4), (-150, 150), (-(2**15), 2**15), (-(2**27), 2**27)])
def test_packed_products_are_exact(low, high, monkeypatch):
    monkeypatch.setattr(negatives, "SLAB", 16)
    draw = np.random.default_rng(3)
    a, x = draw.integers(low, high + 1, (3, 64)), draw.integers(low, high + 1, (53, 64))
    a[0], x[0] = high, low
    want = [[sum(int(p) * int(q) for p, q in zip(u, v, strict=True)) for v in x] for u in a]
    assert inner_products(a, x, low, high).tolist() == want


def test_other_settings(spark):
    rows = some(200, seed=5)
    vectors = spark.createDataFrame(rows, SCHEMA)
    got = hard_negatives(vectors, Workspace(spark, "test"), F.col("vec_id") < 5, positives=2, negatives=1, window=(0, 100))
    assert {r.anchor_id for r in got.collect()} <= set(range(5)) and {r["rank"] for r in got.collect()} == {1}
    assert all(0 <= r.negative_score <= r.positive_score for r in got.collect())
