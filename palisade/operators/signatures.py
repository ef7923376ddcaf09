"""Signature mining: readable ``column = value`` rules that almost always mean an attack.

One pass over the table counts rows and attacks per combination of the categorical columns (and
conditionally per flag column); every single-column and pair rule, and the number of all rows, is then
a roll-up of that small table, which is materialised, so no rule candidate costs another scan.
"""

from __future__ import annotations

from dataclasses import asdict
from functools import reduce
from itertools import combinations
from operator import and_, or_

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.config import SignatureSettings
from palisade.operators.fitted import HasState
from palisade.schema import quoted
from palisade.session import cut_lineage

RULE_SCHEMA = (
    "rank int, conditions map<string,string>, columns array<string>, values array<string>, "
    "support double, confidence double, match_count bigint, rule string"
)


def _generation(df: DataFrame, s: SignatureSettings) -> tuple[list[str], list[str], list[tuple[str, ...]]]:
    """Available categorical columns, flag columns, and the column sets in generation order."""
    categorical = [c for c in s.categorical_columns if c in df.columns]
    flags = [c for c in s.binary_columns if c in df.columns and c not in categorical]
    pairs = list(combinations(categorical, 2)) if s.max_combo_size >= 2 else []
    return categorical, flags, [(c,) for c in categorical] + [(c,) for c in flags] + pairs


def without_rare_values(df: DataFrame, columns: list[str], min_support: float) -> DataFrame:
    """The table with values that are too rare for any rule replaced by null.

    A pair cannot be more frequent than its parts, so no rule is lost, while combinations of rare
    values no longer multiply.  At most ``1 / min_support`` values per column come to the driver.
    """
    if min_support <= 0 or not columns:
        return df
    total = df.count()
    counted = (
        df.select(*[F.col(quoted(c)).cast("string").alias(c) for c in columns])
        .unpivot([], [F.col(quoted(c)) for c in columns], "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") / F.lit(total) >= min_support)
    )
    frequent: dict[str, list[str]] = {c: [] for c in columns}
    for r in counted.collect():
        frequent[r["column"]].append(r["value"])
    return df.withColumns(
        {c: F.when(F.col(quoted(c)).cast("string").isin(frequent[c]), F.col(quoted(c)).cast("string")) for c in columns}
    )


_ALL_ROWS = -1  # the generation of the entry that counts the whole table


def candidate_rules(df: DataFrame, label: str, settings: SignatureSettings, *, whole: bool = False) -> DataFrame:
    """(gen, first, second, n, attacks) for every observed value or value pair.

    ``whole`` adds an entry of all rows, so that supports need no second look at the table.
    """
    categorical, flags, sets = _generation(df, settings)
    if settings.prune_rare:
        df = without_rare_values(df, categorical, settings.min_support)
    y = F.col(quoted(label)).cast("bigint")
    is_set = {c: F.col(quoted(c)) == 1 for c in flags}
    combos = df.groupBy(*[F.col(quoted(c)).cast("string").alias(f"_c{i}") for i, c in enumerate(categorical)]).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(y).alias("attacks"),
        *[F.count_if(is_set[c]).alias(f"_n{i}") for i, c in enumerate(flags)],
        *[F.sum(F.when(is_set[c], y).otherwise(0)).alias(f"_a{i}") for i, c in enumerate(flags)],
    )
    none = F.lit(None).cast("string")
    entries = []
    if whole:
        cells = {"gen": F.lit(_ALL_ROWS), "first": F.lit(""), "second": none, "n": F.col("n"), "attacks": F.col("attacks")}
        entries.append(F.struct(*[c.alias(k) for k, c in cells.items()]))
    for gen, columns in enumerate(sets):
        if columns[0] in flags:
            i = flags.index(columns[0])
            cells = (F.lit("1"), none, F.col(f"_n{i}"), F.col(f"_a{i}"))
        else:
            at = [F.col(f"_c{categorical.index(c)}") for c in columns]
            known = reduce(and_, [a.isNotNull() for a in at])
            cells = (
                F.when(known, at[0]),
                at[1] if len(at) == 2 else none,
                F.col("n"),
                F.col("attacks"),
            )
        names = ("first", "second", "n", "attacks")
        entries.append(F.struct(F.lit(gen).alias("gen"), *[c.alias(k) for c, k in zip(cells, names)]))
    return (
        combos.select(F.inline(F.array(*entries)))
        .filter(F.col("first").isNotNull() & (F.col("n") > 0))
        .groupBy("gen", "first", "second")
        .agg(F.sum("n").alias("n"), F.sum("attacks").alias("attacks"))
    )


def mine_signatures(df: DataFrame, label: str, settings: SignatureSettings | None = None) -> DataFrame:
    """The ranked rules of a labelled table (see ``RULE_SCHEMA``), at most ``max_rules`` of them.

    Support counts against all rows, also those with a missing value.  Rules rank by confidence,
    then support, then generation order.  A pair rule is dropped when one of its two conditions
    is itself a rule ranked before it, that is with at least the same confidence (its support
    cannot be smaller).  The cap comes last.
    """
    s = settings or SignatureSettings()
    _, _, sets = _generation(df, s)
    if not sets:
        return df.sparkSession.createDataFrame([], RULE_SCHEMA)
    candidates = cut_lineage(candidate_rules(df, label, s, whole=True), "candidates")
    total = candidates.filter(F.col("gen") == _ALL_ROWS).first()
    total = total["n"] if total else 0
    passing = (
        candidates.filter(F.col("gen") != _ALL_ROWS)
        .select(
            "gen",
            "first",
            "second",
            F.col("n").alias("match_count"),
            (F.col("n") / F.lit(total)).alias("support"),
            (F.col("attacks") / F.col("n")).alias("confidence"),
        )
        .filter((F.col("support") >= s.min_support) & (F.col("confidence") >= s.min_confidence))
    )
    # Every rule is looked at once per condition; a pair meets its two single rules there.
    pair_of = {gen: columns for gen, columns in enumerate(sets) if len(columns) == 2}
    home = {columns[0]: gen for gen, columns in enumerate(sets) if len(columns) == 1}
    left, right = F.col("gen"), F.lit(None).cast("int")
    for gen, (a, b) in pair_of.items():
        left = F.when(F.col("gen") == gen, home[a]).otherwise(left)
        right = F.when(F.col("gen") == gen, home[b]).otherwise(right)
    is_pair = F.col("second").isNotNull()
    conditions = F.array(
        F.struct(left.alias("column"), F.col("first").alias("value")),
        F.struct(right.alias("column"), F.col("second").alias("value")),
    )
    meeting = Window.partitionBy("condition")
    single_confidence = F.max(F.when(~is_pair, F.col("confidence"))).over(meeting)
    kept = (
        passing.withColumn("condition", F.explode(F.filter(conditions, lambda c: c["value"].isNotNull())))
        .withColumn("general", is_pair & (F.coalesce(single_confidence, F.lit(-1.0)) >= F.col("confidence")))
        .groupBy("gen", "first", "second", "match_count", "support", "confidence")
        .agg(F.max("general").alias("covered"))
        .filter(~F.col("covered"))
    )
    order = [F.desc("confidence"), F.desc("support"), F.asc("gen"), F.asc("first"), F.asc_nulls_first("second")]
    top = kept.orderBy(*order).limit(s.max_rules)

    names = F.element_at(F.array(*[F.array(*[F.lit(c) for c in columns]) for columns in sets]), F.col("gen") + 1)
    values = F.filter(F.array("first", "second"), lambda v: v.isNotNull())
    clauses = F.transform(F.arrays_zip(F.col("columns"), F.col("values")), lambda z: F.concat(z["columns"], F.lit("="), z["values"]))
    return (
        top.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("int"))
        .withColumn("columns", names)
        .withColumn("values", values)
        .select(
            "rank",
            F.map_from_arrays("columns", "values").alias("conditions"),
            "columns",
            "values",
            "support",
            "confidence",
            "match_count",
            F.array_join(clauses, " AND ").alias("rule"),
        )
    )


def rule_text(rules: DataFrame, flags: tuple[str, ...] = SignatureSettings().binary_columns) -> DataFrame:
    """(rank, text): one readable line per rule, text values in quotes."""
    def four_digits(name: str) -> Column:
        return F.call_function("format_number", F.col(name), F.lit("0.0000"))

    def clause(z: Column) -> Column:
        quote = F.when(z["columns"].isin(list(flags)), "").otherwise("'")
        return F.concat(z["columns"], F.lit("="), quote, z["values"], quote)

    # The wording is an output format.
    return rules.select(
        "rank",
        F.format_string(
            "IF %s THEN Attack (support=%s, confidence=%s, n=%d)",
            F.array_join(F.transform(F.arrays_zip("columns", "values"), clause), " AND "),
            four_digits("support"),
            four_digits("confidence"),
            F.col("match_count"),
        ).alias("text"),
    )


def _keys_of(df: DataFrame, rules: DataFrame, flags: tuple[str, ...]):
    """For each set of columns that rules use and the table has: the cells of a row, and the rules' keys."""
    sets = sorted(tuple(r["columns"]) for r in rules.select("columns").distinct().collect())  # sets of columns, not rules
    for columns in sets:
        if all(c in df.columns for c in columns):
            cells = [F.when(F.col(quoted(c)) == 1, "1") if c in flags else F.col(quoted(c)).cast("string") for c in columns]
            own = rules.filter(F.col("columns") == F.array(*[F.lit(c) for c in columns]))
            keys = [F.col("values")[i].alias(f"_value{i}") for i in range(len(columns))]
            same = reduce(and_, [cell == F.col(f"_value{i}") for i, cell in enumerate(cells)])
            yield own, keys, same


def with_rule_hits(
    df: DataFrame, rules: DataFrame, output: str = "sig", flags: tuple[str, ...] = SignatureSettings().binary_columns
) -> DataFrame:
    """Add 1 where any rule of a table (``columns, values``) matches, else 0, for any number of rules.

    One equi-join per set of columns with the different keys of its rules, so expressions grow with the sets of
    columns and not with the rules.  Rows are kept one to one.  A rule on an absent column never matches, nor does
    a missing value.
    """
    names, hit = df.columns, F.lit(False)
    for n, (own, keys, same) in enumerate(_keys_of(df, rules, flags)):
        marks = own.select(*keys).distinct().withColumn(f"_hit{n}", F.lit(True))
        value_columns = [c for c in marks.columns if c.startswith("_value")]
        df = df.join(marks, same, "left").drop(*value_columns)
        hit = hit | F.col(f"_hit{n}").isNotNull()
    return df.select(*[F.col(quoted(c)) for c in names], hit.cast("int").alias(output))


def rule_matches(
    df: DataFrame, rules: DataFrame, row_id: str, flags: tuple[str, ...] = SignatureSettings().binary_columns
) -> DataFrame:
    """``(row_id, rank)``: every rule that matches a row, from the same joins."""
    found = [
        df.join(own.select(*keys, "rank"), same).select(F.col(quoted(row_id)).alias(row_id), "rank")
        for own, keys, same in _keys_of(df, rules, flags)
    ]
    if not found:
        return df.sparkSession.createDataFrame([], df.select(row_id).schema.add("rank", rules.schema["rank"].dataType))
    return reduce(DataFrame.unionByName, found)


class SignatureMiner(Estimator, HasState):
    def __init__(self, settings: SignatureSettings | None = None, label: str = "label", output: str = "sig"):
        super().__init__()
        self.with_state({"settings": asdict(settings or SignatureSettings()), "label": label, "output": output})

    def _fit(self, dataset: DataFrame) -> SignatureModel:
        settings = SignatureSettings(**self.learned["settings"])
        mined = mine_signatures(dataset, self.learned["label"], settings).orderBy("rank")
        rules = [
            [r["columns"], r["values"], r["support"], r["confidence"], r["match_count"], r["rule"]]
            for r in mined.collect()  # at most max_rules rows
        ]
        return SignatureModel().with_state(
            {"rules": rules, "flags": list(settings.binary_columns), "output": self.learned["output"]}
        )


class SignatureModel(Model, HasState):
    """Adds 1 where any learned rule matches the raw row, else 0."""

    @property
    def rule_count(self) -> int:
        return len(self.learned["rules"])

    def rules(self, spark) -> DataFrame:
        rows = [
            (i + 1, dict(zip(r[0], r[1])), r[0], r[1], r[2], r[3], r[4], r[5])
            for i, r in enumerate(self.learned["rules"])
        ]
        return spark.createDataFrame(rows, RULE_SCHEMA)

    def matches(self, df: DataFrame) -> list[Column]:
        """One 0/1 expression per rule, in rank order."""
        out = []
        for columns, values, *_ in self.learned["rules"]:
            if all(c in df.columns for c in columns):
                tests = [self._cell(df, c) == v for c, v in zip(columns, values)]
                out.append(F.coalesce(reduce(and_, tests), F.lit(False)).cast("int"))
            else:
                out.append(F.lit(0))
        return out

    def hit(self, df: DataFrame) -> Column:
        """One boolean expression: per column set, is the row's value among the rules' values.

        Membership tests on literals become hash-set lookups, so the cost depends on the number
        of column sets and hardly on the number of rules.  A rule on an absent column never
        matches, nor does a missing value.
        """
        by_columns: dict[tuple[str, ...], list[list[str]]] = {}
        for columns, values, *_ in self.learned["rules"]:
            if all(c in df.columns for c in columns):
                by_columns.setdefault(tuple(columns), []).append(values)
        tests = []
        for columns, rows in by_columns.items():
            cells = [self._cell(df, c) for c in columns]
            if len(columns) == 1:
                tests.append(cells[0].isin([r[0] for r in rows]))
                continue
            second: dict[str, list[str]] = {}
            for first, other in rows:
                second.setdefault(first, []).append(other)
            tests += [(cells[0] == first) & cells[1].isin(others) for first, others in second.items()]
        if not tests:
            return F.lit(False)
        return F.coalesce(reduce(or_, tests), F.lit(False))

    def _cell(self, df: DataFrame, name: str) -> Column:
        cell = F.col(quoted(name))
        if name in self.learned["flags"]:  # flags match on the number one, however it is stored
            return F.when(cell == 1, "1")
        return cell.cast("string")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.learned["output"], self.hit(dataset).cast("int"))
