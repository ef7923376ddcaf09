import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from palisade.llm.mixing import mix, mix_digest, mixed_rows, split_quotas, targets
from palisade.llm.tables import Workspace
from tests.conftest import TEST_DATA


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def wanted(rows):
    """The targets once more, by moving the excess about in small steps."""
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += words(text)
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, share = Fraction(3 * sum(sizes.values()), 2), {}
    capped = {}
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return sizes, {**capped, **share}
        capped.update({s: Fraction(2 * sizes[s]) for s in over})


ROWS = [(i, "w " * (i * 7919 % 53 + 1), f"s{i % 7 * (i % 3)}") for i in range(900)]
ODD = [(901, None, "s1"), (902, "", None), (903, "x " * 5000, None), (903, "y z", "s1"), (None, "a b", "\U0001f600"), (None, "a b", "￿")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "e", 1) for r in rows], "doc_id bigint, text string, source string, shard string, block int")


def check(rows, got):
    sizes, target = wanted(rows)
    largest, taken = defaultdict(int), defaultdict(int)
    by_size = Counter()
    for doc_id, size, source_size, t, took in got:
        assert took in (0, size, 2 * size)
        by_size[(doc_id, size, source_size, round(t, 6))] += 1
    assert by_size == Counter((i, words(x), sizes[s], round(float(target[s]), 6)) for i, x, s in rows)
    by_target = {(sizes[s], round(float(target[s]), 6)): s for s in sizes}
    if len(by_target) == len(sizes):
        for _, size, source_size, t, took in got:
            s = by_target[source_size, round(t, 6)]
            taken[s] += took
            largest[s] = max(largest[s], size)
        for s in sizes:
            assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6


@pytest.mark.parametrize("rows", [ROWS, ROWS + ODD, ODD[:2], []])
def test_digest(spark, rows):
    got = [tuple(r) for r in mix_digest(frame(spark, rows), Workspace(spark, "test"), blocks=64).collect()]
    check(rows, got)
    again = [tuple(r) for r in mix_digest(frame(spark, rows).repartition(3), Workspace(spark, "test"), blocks=64).collect()]
    assert sorted(got, key=str) == sorted(again, key=str)


def test_documents(spark):
    docs = spark.read.parquet(f"{TEST_DATA}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    check(rows, [tuple(r) for r in mix_digest(docs, Workspace(spark, "test")).collect()])


def test_rows_and_shards(spark):
    docs = frame(spark, ROWS + ODD)
    drawn = mix(docs, Workspace(spark, "test"), shards=8).collect()
    times = Counter()
    for r in drawn:
        times[r.doc_id] += len(r.shards)
        assert all(0 <= s < 8 for s in r.shards)
    rows = mixed_rows(docs, Workspace(spark, "test"), shards=8)
    assert rows.columns == docs.columns and Counter(r.doc_id for r in rows.collect()) == +times


def test_tree_keeps_quotas():
    out = split_quotas([1000, 1, 0, 37], 16)
    assert out.sum(axis=1).tolist() == [1000, 1, 0, 37] and np.ptp(out.sum(axis=0)) <= 1
    assert (out == split_quotas([1000, 1, 0, 37], 16)).all()


def test_targets_are_capped():
    assert targets([10, 1000, 1000], [3, 1, 2], Fraction(3015)) == [20, Fraction(2995, 3), Fraction(5990, 3)]
