import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from palisade.llm.repeats import LENGTH, longest_previous_factors, repeated_windows, repeats_digest, suffix_ranks
from palisade.llm.tables import Workspace
from tests.conftest import TEST_DATA


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    seen, out = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, np.int8)
        for s in range(len(data) - LENGTH + 1):
            window = data[s : s + LENGTH]
            if window in seen:
                gone[s] += 1
                gone[s + LENGTH :][:1] -= 1
            else:
                seen.add(window)
        covered = np.cumsum(gone)[:-1] > 0 if len(data) else np.zeros(0, bool)
        kept = bytes(np.frombuffer(data, np.uint8)[~covered])
        spans = int((np.diff(np.concatenate(([0], covered.astype(int)))) == 1).sum())
        out.append((doc_id, len(data), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **settings):
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, place int, n int")
    return sorted((tuple(r) for r in repeats_digest(docs, Workspace(spark, "test"), **settings).collect()), key=str)


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{TEST_DATA}/documents.parquet").limit(500)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in repeats_digest(docs, Workspace(spark, "test")).collect()), key=str) == brute(rows)


def passages():
    draw = random.Random(5)
    noise = lambda n: "".join(draw.choices("abcdé 🙂", k=n))
    common, line = noise(260), noise(70)
    rows = [(i, noise(draw.randrange(150)) + common[draw.randrange(90) : draw.randrange(150, 260)] + noise(80) + line + noise(60)) for i in range(60)]
    return rows + [(100, None), (101, ""), (102, "x" * 99), (103, "x" * 3000), (104, "xy" * 400), (None, common), (None, common), (7, common), (105, noise(40_000) * 2)]


@pytest.mark.parametrize("heavy", [1000, 3])
def test_passages_equal_brute_force(spark, heavy):
    rows = passages()
    assert run(spark, rows, heavy=heavy) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "a" * 150)]])
def test_few_rows(spark, rows):
    assert run(spark, rows) == brute(rows)


@settings(max_examples=80, deadline=None)
@given(st.binary(min_size=1, max_size=60).map(lambda b: bytes(x % 3 for x in b)))
def test_longest_previous_factors(data):
    values = np.frombuffer(data, np.uint8)
    order = np.array(sorted(range(len(data)), key=lambda i: data[i:]))
    got = dict(zip(order.tolist(), longest_previous_factors(values, order, suffix_ranks(values)).tolist(), strict=True))
    for i in range(len(data)):
        best = 0
        for j in range(i):
            n = 0
            while i + n < len(data) and data[i + n] == data[j + n]:
                n += 1
            best = max(best, n)
        assert got[i] == best


def test_windows_within_segments():
    a = bytes(range(200))
    got = repeated_windows([a, b"zz" + a[20:150], a[:99] + b"!"])
    assert [g.tolist() for g in got] == [[], list(range(2, 33)), []]
