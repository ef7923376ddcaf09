"""Repair of conversations: the cheapest edits after which the roles alternate.

Rows of a conversation are taken by turn (nulls first; rows of one turn by role and text).  A row's first fault
counts: ``blank`` (white space only), ``duplicate`` (role and text seen earlier in the conversation) or ``truncated``
(its last character that is no white space is not one of ``.!?``).  Edits are Keep (cost 0), Rerole to user or
assistant (1), Delete (2; the only edit of blank and duplicate rows) and Insert of an empty user or assistant row
(5); a truncated row that stays costs 5 more.  The initials of the roles must end up as ``(s?(ua)+)?``.  Of the
cheapest sequences of edits the one whose initials come first in ASCII order is taken.

The search is iterative-deepening A*: depth first, in ASCII order of the edits, under a bound that rises to the
smallest cost seen beyond it, with a lower bound of the rest's cost and a table of states that have failed with at
least as much left to spend.  The first accepting path is the answer.  The edits so far matter only by the role
that must come next, one of four states.  So a conversation of more than ``WHOLE`` rows is searched in blocks of
``BLOCK`` rows (short ones, as the bound has to rise far for the dearest pairs of states), for every state before and after, with insertions only before a row; blocks are then chained.  Every path of a block has the
same number of rows in it and ends with a row, so no path starts another, and the chain's first cheapest path is
made of the blocks' first cheapest ones.

Rows are aggregated, so that a row repeated many times is one row with a count, sorted by range partitions, and
streamed.  A conversation that lies inside a partition is done there.  One that reaches a partition's border, or
has more than ``PIECE`` rows, leaves pieces of at most ``PIECE`` rows with their table of costs; a second step
chains the tables, and a third edits each piece by itself.  No task holds a whole long conversation.  Only the
digest reads each conversation in one stream, since its hash is sequential; it holds the initials, not the texts.

A null role or text counts as one space, a null conv_id is a conversation of its own.  Empty tables give no rows.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.llm.tables import Workspace

WHOLE, BLOCK, PIECE = 32, 4, 1_024  # rows
SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5  # costs
#: States: nothing yet; a system row, then user; user, then assistant; assistant, then user or the end.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
WANTED = ("u", "u", "a", "u")  # the initial that an inserted or renamed row gets
ROLES = {"u": "user", "a": "assistant"}
#: What a conversation that stops in a state still needs: its cost, its edits.
ENDING = {START: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}


@lru_cache(maxsize=1 << 16)
def cheapest(rows: str, start: int, end: int | None) -> tuple[int, str] | None:
    """Cost and initials of the first cheapest edits of a block from one state to another; None if there are none.

    A row is written as its role's initial, or ``x`` for others, in capitals if it is truncated, and as ``d`` if it
    must go; the cost of those is not counted.  Without an ``end`` the conversation ends here.
    """
    if end == START and start != START or end == SYSTEM and (start > SYSTEM or start == START and not set(rows) & set("sS")):
        return None
    n = len(rows)
    least = [0] * (n + 1)  # what the rows from here on cost at least
    for i in range(n - 1, -1, -1):
        least[i] = least[i + 1] + (0 if rows[i] in "dsua" else DELETE if rows[i].isupper() else REROLE)

    def search(i: int, state: int, left: int) -> bool:
        """Extend ``path`` to an accepting one for at most ``left``; else note by how much the bound falls short."""
        nonlocal short
        if least[i] > left:
            short = min(short, least[i] - left)
            return False
        if i == n and (end == state or end is None and state in (START, ASSISTANT)):
            return True
        if failed.get((i, state), -1) >= left:
            return False
        edits = []
        if i < n:
            row = rows[i]
            extra = TRUNCATED * row.isupper()
            edits.append(("D", i + 1, state, 0 if row == "d" else DELETE))
        if i < n or end is None:
            edits.append(("I", i, NEXT[state, WANTED[state]], INSERT))
        if i < n and row != "d":
            if (kept := NEXT.get((state, row.lower()))) is not None:
                edits.append(("K", i + 1, kept, KEEP + extra))
            edits.append(("R", i + 1, NEXT[state, WANTED[state]], REROLE + extra))
        for edit, to, then, cost in edits:
            if cost > left:
                short = min(short, cost - left)
                continue
            path.append(edit)
            if search(to, then, left - cost):
                return True
            path.pop()
        failed[i, state] = left
        return False

    bound = least[0]
    while True:
        path, failed, short = [], {}, 1 << 30
        if search(0, start, bound):
            return bound, "".join(path)
        bound += short


Table = dict[tuple[int, int], tuple[int, str]]


def chain(tables: list[Table], start: int, ends: dict[int, int]) -> tuple[int, list[tuple[int, int, str]]] | None:
    """The first cheapest way through tables of (cost, initials) by (state before, state after).

    ``ends`` has the costs of the last state.  Gives the cost, and state before, after and initials of each table.
    """
    rest = [ends]
    for table in reversed(tables):
        here: dict[int, int] = {}
        for (a, b), (cost, _) in table.items():
            if b in rest[-1]:
                here[a] = min(here.get(a, 1 << 60), cost + rest[-1][b])
        rest.append(here)
    rest.reverse()
    if start not in rest[0]:
        return None
    state, taken = start, []
    for table, here, after in zip(tables, rest, rest[1:], strict=False):
        ways = [(edits, b) for (a, b), (cost, edits) in table.items() if a == state and b in after and cost + after[b] == here[state]]
        edits, then = min(ways)
        taken.append((state, then, edits))
        state = then
    return rest[0][start], taken


def table_of(rows: str) -> Table:
    """Cost and initials for any number of rows, by states before and after."""
    blocks = [rows[i : i + BLOCK] for i in range(0, len(rows), BLOCK)]
    states = range(4)
    tables = [{(a, b): w for a in states for b in states if (w := cheapest(block, a, b))} for block in blocks]
    if len(tables) == 1:
        return tables[0]
    out = {}
    for a in states:
        for b in states:
            if way := chain(tables, a, {b: 0}):
                out[a, b] = way[0], "".join(edits for _, _, edits in way[1])
    return out


def whole(rows: str) -> str:
    """The initials for all rows of a conversation."""
    if len(rows) <= WHOLE:
        return cheapest(rows, START, None)[1]
    states = range(4)
    blocks = [rows[i : i + BLOCK] for i in range(0, len(rows), BLOCK)]
    tables = [{(a, b): w for a in states for b in states if (w := cheapest(block, a, b))} for block in blocks]
    _, way = chain(tables, START, {s: cost for s, (cost, _) in ENDING.items()})
    return "".join(edits for _, _, edits in way) + ENDING[way[-1][1]][1]


def marked(rows: DataFrame, workspace: Workspace) -> DataFrame:
    """``conv_id, turn, role, text, n, fault``: equal rows of a turn once, with their number.

    ``fault`` is that of the first of them; the others are blank like it, or duplicates.
    """
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    runs = rows.select("conv_id", "turn", role.alias("role"), text.alias("text")).groupBy("conv_id", "turn", "role", "text")
    same = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    runs = workspace.write(runs.agg(F.count(F.lit(1)).alias("n")).withColumn("same", same), "runs")
    seen = runs.groupBy(F.col("conv_id").alias("of"), F.col("same").alias("as")).agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("runs"))
    seen = seen.filter("runs > 1").drop("runs")
    seen = workspace.write(seen, "seen")
    joined = runs.join(seen, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("same") == F.col("as")), "left")
    bare = F.rtrim("text", F.lit(SPACE))
    fault = (
        F.when(F.length(bare) == 0, "blank")
        .when(F.col("first").isNotNull() & (F.struct("turn") > F.col("first")), "duplicate")
        .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated")
    )
    return workspace.write(joined.select("conv_id", "turn", "role", "text", "n", fault.alias("fault")), "marked")


def _items(row: dict) -> list[dict]:
    """A run as one row, or as its first row and its duplicates."""
    fault, n = row["fault"], row["n"]
    if fault in ("blank", "duplicate"):
        return [row | {"code": "d"}]
    code = row["role"][:1] if row["role"][:1] in tuple("sua") else "x"
    first = row | {"n": 1, "code": code.upper() if fault == "truncated" else code}
    return [first] if n == 1 else [first, row | {"n": n - 1, "fault": "duplicate", "code": "d"}]


_EDIT = "edit string, times bigint, turn bigint, was string, fault string, role string, text string, cost bigint"
_ITEM = "turn bigint, role string, text string, n bigint, fault string, code string"
_WAY = "piece bigint, state bigint, edits string"
#: The first pass leaves edits, items of pieces and tables of pieces, told apart by ``kind``.
_FIRST = f"piece bigint, step bigint, kind string, {_EDIT}, n bigint, code string, steps string"
_ORDER = "piece bigint, step bigint"


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


def _schema(conv: pa.DataType, ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64()}
    return pa.schema([("conv_id", conv), *((name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", ")))])


def edited(items: list[dict], edits: str, state: int) -> Iterator[tuple]:
    """The rows of ``_EDIT`` for items and the initials of their edits."""
    at = 0
    for e in edits:
        if e == "I":
            wanted = WANTED[state]
            yield e, 1, None, None, None, ROLES[wanted], "", INSERT
            state = NEXT[state, wanted]
            continue
        x = items[at]
        at += 1
        role, text, extra = x["role"], x["text"], TRUNCATED * (x["fault"] == "truncated")
        if e == "D":
            yield e, x["n"], x["turn"], x["role"], x["fault"], None, None, DELETE * x["n"]
            continue
        if e == "R":
            role = ROLES[WANTED[state]]
        state = NEXT[state, role[:1]]
        yield e, 1, x["turn"], x["role"], x["fault"], role, text, extra + (REROLE if e == "R" else KEEP)


def _in_partitions(conv: pa.DataType):
    """Edits of the conversations that lie inside a partition, pieces of the others."""
    schema = _schema(conv, _FIRST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        number, held, conversation, split, out = 0, [], None, True, []

        def put(kind: str, piece: int, step: int, **values) -> None:
            out.append({"conv_id": conversation, "piece": piece, "step": step, "kind": kind, **values})

        def piece() -> None:
            nonlocal number, held
            number += 1
            table = table_of("".join(x["code"] for x in held))
            put("table", base + number, -1, steps=";".join(f"{a}{b}{cost}:{edits}" for (a, b), (cost, edits) in table.items()))
            for i, x in enumerate(held):
                put("item", base + number, i, **{c: x[c] for c in _names(_ITEM)})
            held = []

        def close() -> None:
            nonlocal number, held
            number += 1
            for i, e in enumerate(edited(held, whole("".join(x["code"] for x in held)), START)):
                put("edit", base + number, i, **dict(zip(_names(_EDIT), e, strict=True)))
            held = []

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pylist(out, schema)
            out.clear()
            return batch

        any_row = False
        for batch in batches:
            for row in batch.to_pylist():
                if not any_row:
                    any_row, conversation = True, row["conv_id"]  # it may have begun in the partition before
                if row["conv_id"] != conversation:
                    if split:
                        if held:
                            piece()
                    else:
                        close()
                    conversation, split = row["conv_id"], False
                for item in _items(row):
                    if len(held) == PIECE:
                        split = True
                        piece()
                    held.append(item)
            if out:
                yield flush()
        if held:
            piece()  # it may go on in the next partition
        if out:
            yield flush()

    return run


def _chained(conv: pa.DataType):
    """State before and initials of each piece of a conversation."""

    def run(tables: pa.Table) -> pa.Table:
        rows = sorted(zip(tables.column("piece").to_pylist(), tables.column("steps").to_pylist(), strict=True))
        parsed = [{(int(w[0]), int(w[1])): (int((t := w[2:].partition(":"))[0]), t[2]) for w in steps.split(";")} for _, steps in rows]
        _, way = chain(parsed, START, {s: cost for s, (cost, _) in ENDING.items()})
        edits = [e for _, _, e in way]
        edits[-1] += ENDING[way[-1][1]][1]
        who = tables.column("conv_id")[0].as_py()
        found = [{"conv_id": who, "piece": p, "state": w[0], "edits": e} for (p, _), w, e in zip(rows, way, edits, strict=True)]
        return pa.Table.from_pylist(found, _schema(conv, _WAY))

    return run


def _piece_edits(conv: pa.DataType):
    names, schema = _names(_EDIT), _schema(conv, f"{_ORDER}, {_EDIT}")

    def run(items: pa.Table, ways: pa.Table) -> pa.Table:
        way = ways.to_pylist()[0]
        rows = sorted(items.to_pylist(), key=lambda x: x["step"])
        out = []
        for i, e in enumerate(edited(rows, way["edits"], way["state"])):
            out.append({"conv_id": way["conv_id"], "piece": way["piece"], "step": i, **dict(zip(names, e, strict=True))})
        return pa.Table.from_pylist(out, schema)

    return run


def _conversation(rows: DataFrame) -> tuple[str, pa.DataType]:
    """The type of conv_id, in Spark and Arrow."""
    return ("string", pa.string()) if rows.schema["conv_id"].dataType.simpleString() == "string" else ("bigint", pa.int64())


def repair_edits(rows: DataFrame, workspace: Workspace) -> DataFrame:
    """One row per edit: ``conv_id, piece, step`` (their order), ``edit, times, turn, was, fault, role, text, cost``.

    ``edit`` is K, R, D or I; ``was`` the role before; ``role`` and ``text`` what stays, null where a row goes.
    Deleted duplicates of one turn are one row with their number in ``times``.
    """
    kind, conv = _conversation(rows)
    rows = rows.withColumn("conv_id", F.col("conv_id").cast(kind)).withColumn("turn", F.col("turn").cast("long"))
    found = marked(rows, workspace)
    # Bounded keys that follow the order, so that sampled range bounds stay small.
    head = F.substring("role", 1, 32)
    longer = F.length("role") > 32
    begin = F.when(longer, "").otherwise(F.substring("text", 1, 32))
    spread = found.repartitionByRange("conv_id", "turn", head, longer, begin).sortWithinPartitions("conv_id", "turn", "role", "text")
    first = workspace.write(spread.mapInArrow(_in_partitions(conv), f"conv_id {kind}, {_FIRST}"), "first")
    tables = first.filter("kind = 'table'").select("conv_id", "piece", "steps")
    ways = workspace.write(tables.groupBy("conv_id").applyInArrow(_chained(conv), f"conv_id {kind}, {_WAY}"), "ways")
    items = first.filter("kind = 'item'").select("piece", "step", *_names(_ITEM))
    late = items.groupBy("piece").cogroup(ways.groupBy("piece")).applyInArrow(_piece_edits(conv), f"conv_id {kind}, {_ORDER}, {_EDIT}")
    return first.filter("kind = 'edit'").select("conv_id", *_names(f"{_ORDER}, {_EDIT}")).unionByName(workspace.write(late, "late"))


_DIGEST = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def _digests(conv: pa.DataType):
    schema = _schema(conv, _DIGEST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []

        def fresh(conversation) -> dict:
            return {"conv_id": conversation, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": [],
                    "sha": hashlib.sha256(), "lines": 0, "low": None, "last": None, "turns": 0, "role": None}

        def result(x: dict) -> dict:
            gaps = 0 if x["low"] is None else x["last"] - x["low"] + 1 - x["turns"]
            return {"conv_id": x["conv_id"], "gaps": gaps, **{c: x[c] for c in ("blank", "duplicate", "truncated", "illegal", "cost")},
                    "audit": "".join(x["audit"]), "repaired_sha256": x["sha"].hexdigest()}

        for batch in batches:
            for row in batch.to_pylist():
                if now is None or row["conv_id"] != now["conv_id"]:
                    if now is not None:
                        out.append(result(now))
                    now = fresh(row["conv_id"])
                if row["edit"] is None:
                    continue  # says only that the conversation exists
                now["audit"].append(row["edit"] * row["times"])
                now["cost"] += row["cost"]
                if row["edit"] != "I":
                    if row["fault"]:
                        now[row["fault"]] += row["times"]
                    initial = row["was"][:1]
                    now["illegal"] += (row["times"] - 1) + (now["role"] is not None and now["role"] + initial not in ("su", "ua", "au"))
                    now["role"] = initial
                    if row["turn"] is not None and row["turn"] != now["last"]:
                        now["low"] = row["turn"] if now["low"] is None else now["low"]
                        now["last"] = row["turn"]
                        now["turns"] += 1
                if row["edit"] != "D":
                    now["sha"].update((("\n" if now["lines"] else "") + f"{row['role']}:{row['text']}").encode())
                    now["lines"] += 1
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([result(now)], schema)

    return run


def repair_report(conversations: DataFrame, rows: DataFrame, workspace: Workspace) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of every conversation.

    ``rows`` are repaired; ``conversations`` says which ids there are, also those of which no row is left.
    """
    edits = repair_edits(rows, workspace)
    kind, conv = _conversation(edits)
    empty = [F.lit(None).cast(edits.schema[c].dataType).alias(c) for c in _names(_EDIT)]
    every = conversations.select(F.col("conv_id").cast(kind)).distinct()
    every = every.select("conv_id", F.lit(-1).cast("long").alias("piece"), F.lit(-1).cast("long").alias("step"), *empty)
    stream = edits.unionByName(every).repartition("conv_id").sortWithinPartitions("conv_id", "piece", "step")
    return stream.mapInArrow(_digests(conv), f"conv_id {kind}, {_DIGEST}")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, without stops, repeated or given to the user, by a hash of conversation and turn."""
    name = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")])
    draw = F.crc32(name) % 20
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), draw.alias("draw"))
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("draw") == 4, "user").otherwise(F.col("role"))
    times = F.array_repeat(F.lit(0), F.when(F.col("draw") == 3, 2).otherwise(1))
    return rows.filter("draw <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times)).drop("col")


def repair_digest(conversations: DataFrame, workspace: Workspace) -> DataFrame:
    return repair_report(conversations, damaged(conversations), workspace)


REPAIR_SQL = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), drawn AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name,
    xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(1, length(name) + 1), lambda i: CAST(ascii(substr(name, i, 1)) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) % 20 AS draw
  FROM conversations, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN draw = 1 THEN '' WHEN draw = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN draw = 3 THEN 2 ELSE 1 END)) FROM drawn WHERE draw <> 0)
), ordered AS (
  SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM damaged
), faulty AS (
  SELECT *, left(role, 1) AS initial,
    CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM ordered
), inserted(last, extra, more, next) AS (
  VALUES ('', 0, '', ''), ('', 5, 'I', 'u'), ('', 10, 'II', 'a'), ('s', 0, '', 's'), ('s', 5, 'I', 'u'), ('s', 10, 'II', 'a'),
    ('u', 0, '', 'u'), ('u', 5, 'I', 'a'), ('a', 0, '', 'a'), ('a', 5, 'I', 'u')
), edits(edit, price) AS (VALUES ('D', 2), ('K', 0), ('R', 1)),
ways AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '' AS last, 0 AS cost, '' AS audit FROM faulty
  UNION ALL
  SELECT conv_id, i, last, cost, audit FROM (
    SELECT f.conv_id, f.i, CASE edit WHEN 'D' THEN x.next WHEN 'K' THEN f.initial ELSE CASE x.next WHEN 'u' THEN 'a' ELSE 'u' END END AS last,
      w.cost + extra + price + CASE WHEN fault = 'truncated' AND edit <> 'D' THEN 5 ELSE 0 END AS cost, w.audit || more || edit AS audit
    FROM ways w JOIN faulty f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = w.i + 1 JOIN inserted x ON x.last = w.last, edits
    WHERE (edit = 'D' OR fault IN ('', 'truncated'))
      AND (edit <> 'K' OR x.next || f.initial IN ('s', 'u', 'su', 'ua', 'au') AND (f.initial <> 's' OR x.next = ''))
  ) QUALIFY row_number() OVER (PARTITION BY conv_id, last ORDER BY cost, audit) = 1
), best AS (
  SELECT conv_id, cost + CASE last WHEN 'u' THEN 5 WHEN 's' THEN 10 ELSE 0 END AS total, audit || CASE last WHEN 'u' THEN 'I' WHEN 's' THEN 'II' ELSE '' END AS edits
  FROM ways w WHERE i = (SELECT max(f.i) FROM faulty f WHERE f.conv_id IS NOT DISTINCT FROM w.conv_id)
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY total, edits) = 1
), steps AS (
  SELECT conv_id, p, substr(edits, p, 1) AS edit FROM (SELECT conv_id, edits, unnest(range(1, length(edits) + 1)) AS p FROM best)
), placed AS (
  SELECT *, sum(CASE WHEN edit <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY p) AS i FROM steps
), kept AS (
  SELECT s.conv_id, p, edit, role, text, initial, row_number() OVER line AS j,
    first_value(edit = 'K' AND initial = 's') OVER line AS system_first
  FROM placed s LEFT JOIN faulty f ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND s.i = f.i AND edit <> 'I'
  WHERE edit <> 'D' WINDOW line AS (PARTITION BY s.conv_id ORDER BY p)
), repaired AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (j + CASE WHEN system_first THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS lines
  FROM kept GROUP BY conv_id
), pairs AS (
  SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM faulty
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM pairs GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(total, 0) AS BIGINT) AS cost, coalesce(edits, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counted n ON c.conv_id IS NOT DISTINCT FROM n.conv_id
LEFT JOIN best b ON c.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN repaired r ON c.conv_id IS NOT DISTINCT FROM r.conv_id
"""
