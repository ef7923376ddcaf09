import hashlib

from pyspark.sql import functions as F

from palisade.llm.exact import exact_duplicates
from palisade.llm.tables import Workspace


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max(ids, key=lambda x: -1 if x is None else x)
        sha = hashlib.sha256(text.encode()).hexdigest()
        first = True
        for doc_id in sorted(ids, key=lambda x: -1 if x is None else x):
            stays = doc_id == keep and first
            first = first and not stays
            out.append((doc_id, keep, len(ids), stays, sha))
    return sorted(out, key=str)


def run(spark, rows, **settings):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, kept string, name int")
    got = exact_duplicates(docs, Workspace(spark, "test"), **settings).collect()
    return sorted((tuple(r) for r in got), key=str)


ROWS = [(1, "abc"), (2, "abc"), (3, None), (4, ""), (5, "é" * 9000), (6, "é" * 9000), (7, "é" * 8999 + "e"), (8, "abcd" * 5),
        (9, "abcd" * 5), (9, "abcd" * 5), (None, "abc"), (None, "z"), (None, "z"), (10, "abab"), (11, "abba")]


def test_groups_equal_brute_force(spark):
    assert run(spark, ROWS) == brute(ROWS)


def test_small_blocks_and_shared_fingerprints(spark):
    assert run(spark, ROWS, block_bytes=2, fingerprint=lambda b: F.pmod(F.xxhash64(b), F.lit(2))) == brute(ROWS)


def test_no_rows(spark):
    assert run(spark, []) == []
