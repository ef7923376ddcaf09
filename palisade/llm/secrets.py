"""Secret scans with a trigram inverted index, in DataFrame operations only.

Each rule is a regular expression.  On the driver its syntax tree is turned into a Boolean trigram
query: an OR of sets of trigrams of which all must occur in a matching text (lower-cased).  The index
holds one posting (trigram, doc_id) per trigram of the rules' vocabulary and document.  Postings of a
set are intersected, the sets of a rule are united, and the rule is verified on its candidates only.
A rule whose expression has a match without any mandatory trigram is run over every text.

The index is an ordinary table: a frequent trigram is spread over many partitions, and intersections
are counts per (rule, set, document), so nothing is gathered per trigram.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import product
from re import _constants as op  # type: ignore[attr-defined]
from re import _parser as parser  # type: ignore[attr-defined]

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.llm.tables import Workspace

MAX_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches; those whose ``group`` has fewer than ``least`` characters are dropped.

    Expressions keep to the syntax that Python, Java and RE2 read alike.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The three base rules come first, in the order in which they are listed in digests.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),  # the runs of [0-9a-f]+ that are long enough
)
MORE_RULES = (
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("login_url", r"[a-z]{2,12}://[A-Za-z0-9._-]{1,64}:[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9.-]+"),
)

Needs = set[frozenset[str]]
FREE: Needs = {frozenset()}


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _simpler(needs: Needs) -> Needs:
    """Without the sets that ask for more than another one."""
    return {x for x in needs if not any(y < x for y in needs)}


def _both(a: Needs, b: Needs) -> Needs:
    if len(a) * len(b) > MAX_STRINGS:  # keep the stricter side, a weaker query is still right
        return min(a, b, key=lambda needs: (min(map(len, needs)) == 0, len(needs)))
    return _simpler({x | y for x, y in product(a, b)})


def _read(tree) -> tuple[set[str] | None, Needs]:
    """Of a syntax tree: all the strings it matches, if they are few; and what a match must contain."""
    run: set[str] = {""}
    needs: Needs = FREE
    exact = True
    for what, arg in tree:
        strings, inner = _node(what, arg)
        if strings is not None and len(run) * len(strings) <= MAX_STRINGS:
            run = {a + b for a, b in product(run, strings)}
            continue
        needs = _both(needs, _simpler({_trigrams(s) for s in run}))
        if strings is None:
            exact, run = False, {""}
            needs = _both(needs, inner)
        else:
            exact, run = False, strings
    needs = _both(needs, _simpler({_trigrams(s) for s in run}))
    return (run if exact else None), needs


def _node(what, arg) -> tuple[set[str] | None, Needs]:
    if what is op.LITERAL:
        return {chr(arg).lower()}, FREE
    if what is op.IN and len(arg) <= 8 and all(kind is op.LITERAL for kind, _ in arg):
        return {chr(code).lower() for _, code in arg}, FREE
    if what is op.SUBPATTERN:
        return _read(arg[3])
    if what is op.AT:
        return {""}, FREE
    if what is op.BRANCH:
        parts = [_read(x) for x in arg[1]]
        if all(strings is not None for strings, _ in parts):
            return set().union(*(strings for strings, _ in parts)), FREE
        return None, _simpler(set().union(*(inner for _, inner in parts)))
    if what in (op.MAX_REPEAT, op.MIN_REPEAT):
        low, high, tree = arg
        strings, inner = _read(tree)
        if strings is not None and (low, high) == (0, 1):
            return strings | {""}, FREE
        if strings is not None and low == high and len(strings) ** low <= MAX_STRINGS:
            return {"".join(x) for x in product(strings, repeat=low)}, FREE
        return None, inner if low else FREE
    return None, FREE


def trigram_query(pattern: str) -> Needs | None:
    """An OR of sets of trigrams, each set an AND; None where some match needs no trigram."""
    needs = _read(parser.parse(pattern))[1]
    return None if frozenset() in needs else needs


def trigram_index(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Postings ``trigram, doc_id`` of the vocabulary's trigrams in the lower-cased texts, each once.

    Sorted by trigram, so that a reader of a few trigrams skips the rest of the files.  A null or empty
    text has no posting; rows that repeat a doc_id share their postings.
    """
    low = docs.select("doc_id", F.lower("text").alias("low"))
    found = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in vocabulary)))
    return (
        low.select("doc_id", found.alias("found")).select("doc_id", F.explode("found").alias("trigram"))
        .distinct().repartitionByRange("trigram", "doc_id").sortWithinPartitions("trigram", "doc_id")
        .select("trigram", "doc_id")
    )


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``doc_id, rules``: the rules with mandatory trigrams that may match, found by intersecting postings."""
    terms = [
        (rule.kind, branch, t, len(needed))
        for rule in rules
        for branch, needed in enumerate(sorted(map(sorted, trigram_query(rule.pattern) or ())))
        for t in needed
    ]
    terms = index.sparkSession.createDataFrame(terms, "rule string, branch int, trigram string, needed int")
    met = index.join(F.broadcast(terms), "trigram").groupBy("doc_id", "rule", "branch", "needed").count()
    return met.filter("count = needed").groupBy("doc_id").agg(F.collect_set("rule").alias("rules"))


def _step(place: int, rule: Rule) -> Callable[[Column, Column], Column]:
    def step(done: Column, x: Column) -> Column:
        start = done["at"] + x["gap"]
        end = start + x["width"]
        span = F.struct(start.alias("start"), F.lit(place).alias("place"), end.alias("end"),
                        F.lit(rule.kind).alias("kind"), (x["part"] >= rule.least).alias("ok"))
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(span)).alias("out"))

    return step


def _spans(rules: tuple[Rule, ...]) -> Column:
    """Spans of all rules, sorted by start and by the order of the rules; characters, end exclusive."""
    each = []
    none = F.expr("cast(array() as array<struct<start: int, place: int, end: int, kind: string, ok: boolean>>)")
    for i, rule in enumerate(rules):
        steps = F.arrays_zip(
            F.transform(F.slice(f"_gap{i}", 1, F.size(f"_hit{i}")), F.char_length).alias("gap"),
            F.transform(f"_hit{i}", F.char_length).alias("width"),
            F.transform(f"_part{i}", F.char_length).alias("part"),
        )
        start = F.struct(F.lit(0).alias("at"), none.alias("out"))
        spans = F.aggregate(steps, start, _step(i, rule))["out"]
        each.append(F.when(F.size(f"_hit{i}") > 0, spans).otherwise(none))
    return F.array_sort(F.filter(F.concat(*each), lambda x: x["ok"]))


def find_secrets(docs: DataFrame, workspace: Workspace, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> DataFrame:
    """``doc_id, spans`` per row, spans an array of (start, place, end, kind) where place numbers the rules.

    Null counts as empty and has no spans.  Rows with a repeated or null doc_id share their candidates
    but are verified one by one.
    """
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    vocabulary = sorted({t for needs in queries.values() if needs for needed in needs for t in needed})
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    if vocabulary:
        index = workspace.write(trigram_index(docs, vocabulary), "trigram-index")
        found = candidates(index, rules).withColumnRenamed("doc_id", "_id")
        texts = texts.join(found, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    else:
        texts = texts.withColumn("rules", F.lit(None).cast("array<string>"))

    none = F.expr("cast(array() as array<string>)")

    def tested(rule: Rule) -> Column:
        if queries[rule.kind] is None:
            return F.lit(True)
        return F.coalesce(F.array_contains("rules", rule.kind), F.lit(False))

    def all_of(rule: Rule, group: int) -> Column:
        return F.regexp_extract_all("_text", F.lit(rule.pattern), F.lit(group))

    hits = texts.select("doc_id", "_text", *(
        F.when(tested(r), all_of(r, 0)).otherwise(none).alias(f"_hit{i}") for i, r in enumerate(rules)
    ))
    for i, r in enumerate(rules):
        met = F.size(f"_hit{i}") > 0
        hits = hits.withColumns({
            f"_gap{i}": F.when(met, F.split("_text", r.pattern, -1)).otherwise(none),
            f"_part{i}": F.when(met, all_of(r, r.group)).otherwise(none) if r.group else F.col(f"_hit{i}"),
        })
    return hits.select("doc_id", _spans(rules).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def _of(place: int) -> Callable[[Column], Column]:
    return lambda x: x["place"] == place


def secrets_digest(docs: DataFrame, workspace: Workspace) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans``; spans holds those of all rules."""
    found = find_secrets(docs, workspace)
    base = F.filter("spans", lambda x: x["place"] < len(BASE_RULES))
    counts = [
        F.size(F.filter("spans", _of(i))).cast("long").alias(f"n_{rule.kind}") for i, rule in enumerate(BASE_RULES)
    ]
    return found.select("doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"))


def secrets_sql(rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> str:
    """The digest in DuckDB: every rule over every text, without an index."""

    def text(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    found = " UNION ALL ".join(
        f"""SELECT doc_id, {i} AS place, '{r.kind}' AS kind, regexp_extract_all(text, {text(r.pattern)}, 0) AS hits,
          regexp_extract_all(text, {text(r.pattern)}, {r.group}) AS parts,
          string_split_regex(text, {text(r.pattern)}) AS gaps, {r.least} AS least
        FROM documents WHERE text IS NOT NULL"""
        for i, r in enumerate(rules)
    )
    base = len(BASE_RULES)
    return f"""
    WITH found AS ({found}),
    each AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM found WHERE len(hits) > 0),
    spans AS (SELECT doc_id, place, kind,
        list_sum([length(x) for x in gaps[1:i]])::BIGINT
          + coalesce(list_sum([length(x) for x in hits[1:i - 1]]), 0)::BIGINT AS start,
        length(hits[i]) AS width
      FROM each WHERE length(parts[i]) >= least),
    digests AS (SELECT doc_id, {", ".join(f"count(*) FILTER (place = {i}) AS n_{r.kind}" for i, r in enumerate(BASE_RULES))},
        coalesce(string_agg(concat(kind, ':', start, ':', start + width), ',' ORDER BY start, place)
          FILTER (place < {base}), '') AS base,
        string_agg(concat(kind, ':', start, ':', start + width), ',' ORDER BY start, place) AS spans
      FROM spans GROUP BY doc_id)
    SELECT d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}" for r in BASE_RULES)},
      sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM documents d LEFT JOIN digests g ON d.doc_id = g.doc_id
    """
