import hashlib
import re

from palisade.llm.leaks import find_leaks, leaks_digest
from palisade.llm.tables import Workspace

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, ids = split(text), set(), set()
        for item_id, item in items:
            v = split(item)
            size = min(len(v), 10)
            for j in range(len(v) - size + 1 if v else 0):
                for i in range(len(w) - size + 1):
                    if w[i : i + size] == v[j : j + size]:
                        hit |= set(range(i, i + size))
                        ids.add("null" if item_id is None else str(item_id))
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(ids), sha, bool(hit)))
    return sorted(out, key=str)


LONG = " ".join(f"w{i}" for i in range(30))
ITEMS = [(1, LONG), (2, "Two words"), (10, "É only-three x"), (3, None), (4, "!!"), (5, "solo"), (5, "a b c d e f g h i"),
         (None, "null item has nine words in it right here"), (7, LONG.replace("w12", "other"))]
DOCS = [(1, "x " + LONG.upper() + " y"), (2, "two, WORDS! two words"), (3, None), (4, ""), (5, "É only three x é only three"),
        (6, " ".join(f"w{i}" for i in range(5, 15)) + " z " + " ".join(f"w{i}" for i in range(9))), (7, "SOLO"), (7, "solo"),
        (None, "a b c d e f g h i j"), (8, "null item has nine words in it right here"), (9, "q " * 200_000 + LONG),
        (11, "é" * 50)]


def frames(spark, docs=DOCS, items=ITEMS):
    return (
        spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id bigint, text string, item_id string, n_words int"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )


def test_digest_equals_brute_force(spark):
    got = leaks_digest(*frames(spark), Workspace(spark, "test")).collect()
    assert sorted(map(tuple, got), key=str) == brute(DOCS, ITEMS)


def test_blocks_give_the_same(spark):
    got = leaks_digest(*frames(spark), Workspace(spark, "test"), block_bytes=40).collect()
    assert sorted(map(tuple, got), key=str) == brute(DOCS, ITEMS)


def test_longest_matches(spark):
    rows = {r.doc_id: r.matches for r in find_leaks(*frames(spark, DOCS[:1], ITEMS[:1]), Workspace(spark, "test")).collect()}
    assert [tuple(m) for m in rows[1]] == [(1, "1", 0, 30)]


def test_empty_tables(spark):
    assert leaks_digest(*frames(spark, []), Workspace(spark, "test")).collect() == []
    got = leaks_digest(*frames(spark, DOCS, []), Workspace(spark, "test")).collect()
    assert sorted(map(tuple, got), key=str) == brute(DOCS, [])


def test_longest_passage_of_any_item(spark):
    """The longest passage decides, not the first item that shares a window."""
    items = [(1, "a b c d e f g h i j"), (2, "x a b c d e f g h i j k l"), (3, "b c d e f g h i j k l m n")]
    docs = [(1, "z a b c d e f g h i j k l m n o")]
    row = find_leaks(*frames(spark, docs, items), Workspace(spark, "test")).first()
    assert [tuple(m) for m in row.matches] == [(1, "2", 1, 12), (4, "3", 2, 11)] and row.items == ["1", "2", "3"]


def test_a_window_that_many_items_and_places_share(spark):
    """A thousand items and a thousand places of one window: hits grow with the places, not with the product."""
    common = "one two three four five six seven eight nine ten"
    items = [(i, f"{common} own{i} word{i}") for i in range(1000)]
    docs = [(1, " ".join([common] * 1000)), (2, f"{common} own7 word7"), (3, "clean")]
    found = {r.doc_id: r for r in find_leaks(*frames(spark, docs, items), Workspace(spark, "test")).collect()}
    assert len(found[1].matches) == 1000 and len(found[1].items) == 1000
    assert [tuple(m) for m in found[2].matches] == [(0, "7", 0, 12)] and found[3].matches == []
    got = {r.doc_id: (r.n_hit, r.n_items) for r in leaks_digest(*frames(spark, docs, items), Workspace(spark, "test")).collect()}
    assert got == {1: (10_000, 1000), 2: (12, 1000), 3: (0, 0)}


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", LONG), ("a", "clean"), (None, None)], "doc_id string, text string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = {r.doc_id: r.n_hit for r in leaks_digest(docs, items, Workspace(spark, "test")).collect()}
    assert got == {"b": 30, "a": 0, None: 0}
