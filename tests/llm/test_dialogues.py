import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

import palisade.llm.dialogues as dialogues
from palisade.llm.dialogues import ENDING, chain, cheapest, repair_digest, table_of, whole
from palisade.llm.tables import Workspace
from tests.conftest import TEST_DATA

NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def first_cheapest(rows):
    """(cost, initials) by every sequence of edits that may be best: a table over rows and last initials."""
    ways = {"": (0, "")}
    for fault, initial in [*rows, (None, None)]:
        wide = dict(ways)
        for _ in range(2):  # insertions before the row
            for last, (cost, audit) in list(wide.items()):
                to = "a" if last == "u" else "u"
                wide[to] = min(wide.get(to, (10**9, "")), (cost + 5, audit + "I"))
        if fault is None:
            return min(wide[x] for x in ("", "a") if x in wide)
        ways = {}

        def offer(last, cost, audit, ways=ways):
            ways[last] = min(ways.get(last, (10**9, "")), (cost, audit))

        for last, (cost, audit) in wide.items():
            offer(last, cost + 2, audit + "D")
            if fault in ("", "truncated"):
                extra = 5 * (fault == "truncated")
                if (last, initial) in NEXT:
                    offer(NEXT[last, initial], cost + extra, audit + "K")
                offer("a" if last == "u" else "u", cost + extra + 1, audit + "R")
    return None


def brute(rows):
    by = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        role = "user" if draw == 4 else role
        by[conv] += [(turn, role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    out = []
    for conv, left in by.items():
        left = sorted(left, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in left:
            bare = text.rstrip(SPACE)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        cost, audit = first_cheapest([(f, r[1][:1]) for f, r in zip(faults, left, strict=True)])
        lines, i, last = [], 0, ""
        for e in audit:
            if e in "IR":
                last = "a" if last == "u" else "u"
                lines.append(("assistant:" if last == "a" else "user:") + (left[i][2] if e == "R" else ""))
            elif e == "K":
                last = left[i][1][:1]
                lines.append(f"{left[i][1]}:{left[i][2]}")
            i += e != "I"
        turns = {t for t, _, _ in left if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(left, left[1:], strict=False))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, parts=5):
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, piece int, edit string").repartition(parts)
    got = repair_digest(table, Workspace(spark, "test"))
    names = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    return sorted((tuple(r) for r in got.select(*names).collect()), key=str)


def talk(conv, n, draw, noise=0.2):
    rows = []
    for t in range(n):
        role = ("user", "assistant")[t % 2]
        text = f"words {draw.randrange(50)} of turn {t}."
        if draw.random() < noise:
            role = draw.choice(["user", "assistant", "system", "tool", "", None, "User"])
        if draw.random() < noise:
            text = draw.choice(["", None, " \t\x0b", "no end", "What? ", "same.", "same.", " ", "end. "])
        rows.append((conv, t + (draw.random() < 0.05) if draw.random() > 0.02 else None, role, text, 0, "K"))
    return rows


def test_conversations_equal_brute_force(spark):
    table = spark.read.parquet(f"{TEST_DATA}/conversations.parquet")
    rows = [(*r, 0, "") for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = run(spark, rows)
    assert got == brute(rows) and len({r[7] for r in got}) > 10


@pytest.mark.parametrize(("longest", "block", "piece"), [(32, 4, 1024), (2, 3, 7), (0, 1, 1)])
def test_noisy_and_long_conversations(spark, monkeypatch, longest, block, piece):
    monkeypatch.setattr(dialogues, "WHOLE", longest)
    monkeypatch.setattr(dialogues, "BLOCK", block)
    monkeypatch.setattr(dialogues, "PIECE", piece)
    draw = random.Random(4)
    rows = [r for c in range(60) for r in talk(c, draw.randrange(1, 14), draw)] + talk(500, 700, draw) + talk(None, 40, draw, 0.5)
    assert run(spark, rows, 9) == brute(rows)


def test_one_row_repeated_and_odd_cases(spark):
    rows = [(1, 5, "user", "the same.", 0, "")] * 3000 + [(1, 4, "user", "the same.", 0, ""), (1, 9, "assistant", "yes" * 100_000 + ".", 0, "")]
    rows += [(2, None, None, None, 0, ""), (3, 7, "system", "only.", 0, ""), (4, -5, "user", "a.", 0, ""), (4, 5, "user", "a.", 0, "")]
    rows += [(c, t, "user", "tie.", 0, "") for c in range(10, 60) for t in (1, 1, 2)] + [(c, 1, "assistant", "tie.", 0, "") for c in range(10, 60)]
    rows += [(c, 1, "user", "single.", 0, "") for c in range(1000, 1060)]
    rows += [(70, 1, "x" * 40 + e, t, 0, "") for e in ("", "a", "b") for t in ("one.", "two.")]
    got = run(spark, rows)
    assert got == brute(rows)
    assert any(r[7] == "" for r in got)  # some conversation has lost all its rows


def test_empty_table(spark):
    assert run(spark, []) == []


def test_search_equals_dynamic_programming():
    draw = random.Random(1)
    faults = {"d": "blank", "S": "truncated", "U": "truncated", "A": "truncated", "X": "truncated"}
    for _ in range(400):
        rows = "".join(draw.choice("ssuuuaaaxdSUAX") for _ in range(draw.randrange(0, 33)))
        cost, audit = first_cheapest([(faults.get(c, ""), c.lower()) for c in rows])
        assert cheapest(rows, 0, None) == (cost - 2 * rows.count("d"), audit)
        pieces = [rows[i : i + 5] for i in range(0, len(rows), 5)]
        if pieces:
            found, way = chain([table_of(p) for p in pieces], 0, {s: c for s, (c, _) in ENDING.items()})
            assert (found, "".join(w[2] for w in way) + ENDING[way[-1][1]][1]) == (cost - 2 * rows.count("d"), audit)
            assert whole(rows * 3) == first_cheapest([(faults.get(c, ""), c.lower()) for c in rows * 3])[1]
