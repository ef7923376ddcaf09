"""Many categories, many columns, many rules: the forms whose size is a table's and not an expression's."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.operators import correlation, sparse
from palisade.operators.signatures import rule_matches, with_rule_hits
from palisade.plans import views
from palisade.plans.queries.registry import query

# --- sparse one-hot ----------------------------------------------------------------

_CATEGORIES = ["part", "supplier", "flag", "day"]
_WIDE = f"""
SELECT {views.ROW_ID} AS row_id, 'part-' || l_partkey AS part, 'supplier-' || l_suppkey AS supplier,
  CASE WHEN l_linenumber = 3 AND l_quantity = 7 THEN NULL ELSE l_returnflag || l_linestatus END AS flag,
  CAST(CAST(l_shipdate AS DATE) AS STRING) AS day, substr(CAST(CAST(l_shipdate AS DATE) AS STRING), 1, 7) AS month,
  l_discount AS discount, l_quantity AS quantity
FROM lineitem
"""


def _dictionary_sql(columns: list[str]) -> str:
    cells = " UNION ALL ".join(f"SELECT row_id, {i} AS place, '{c}' AS \"column\", {c} AS value FROM wide" for i, c in enumerate(columns))
    return f"""WITH wide AS ({_WIDE}), cells AS (SELECT * FROM ({cells}) WHERE value IS NOT NULL),
    dictionary AS (SELECT "column", value, row_number() OVER (ORDER BY place, value) - 1 AS "index"
      FROM (SELECT DISTINCT place, "column", value FROM cells)),
    ones AS (SELECT row_id, "index" AS k FROM cells JOIN dictionary USING ("column", value))"""


_DICTIONARY = _dictionary_sql(_CATEGORIES)


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views._over(spark, _WIDE, lineitem=views.table(spark, sf_dir, "lineitem"))


@query("category_dictionary", f'{_DICTIONARY} SELECT "column", value, "index" FROM dictionary')
def category_dictionary(spark, sf_dir):
    return sparse.category_dictionary(_wide(spark, sf_dir), _CATEGORIES).select("column", "value", "index")


@query(
    "sparse_one_hot",
    f"""{_DICTIONARY}
    SELECT row_id, 0 AS "index", CAST(discount AS DOUBLE) AS value FROM wide WHERE discount <> 0
    UNION ALL SELECT row_id, 1, CAST(quantity AS DOUBLE) FROM wide WHERE quantity <> 0
    UNION ALL SELECT row_id, CAST(k + 2 AS INTEGER), CAST(1 AS DOUBLE) FROM ones""",
)
def sparse_one_hot(spark, sf_dir):
    wide = _wide(spark, sf_dir)
    model = sparse.SparseOneHot(_CATEGORIES, ["discount", "quantity"]).fit(wide)
    return model.entries(wide).select("row_id", F.inline("entries"))


# --- correlation of many columns ------------------------------------------------------

N_DERIVED = 210


def _derived(k: int) -> str:
    """Column k: remainders of mixed keys; every tenth almost repeats the one before, every fifteenth mirrors it."""
    if k % 10 == 9:
        return f"2 * ({_derived(k - 1)}) + l_linenumber"
    if k % 15 == 14:
        return f"100 - ({_derived(k - 1)})"
    if k == 33:
        return "7"
    return f"(l_partkey * {k + 3} + l_suppkey * {k % 5} + l_orderkey * {k % 3}) % {31 + k}"


_COLUMNS = [f"c{k}" for k in range(N_DERIVED)]
_MANY = "SELECT " + ", ".join(f"CAST({_derived(k)} AS DOUBLE) AS c{k}" for k in range(N_DERIVED)) + " FROM lineitem"
_ALL_CORRELATIONS = ", ".join(
    f"{{'first': {a}, 'second': {b}, 'r': CASE WHEN {33} IN ({a}, {b}) THEN NULL ELSE corr(c{a}, c{b}) END}}" for b in range(N_DERIVED) for a in range(b)
)


@query(
    "correlated_columns",
    f"""WITH many AS ({_MANY}), pairs AS (SELECT unnest([{_ALL_CORRELATIONS}]) AS p FROM many)
    SELECT CAST(p.first AS INTEGER) AS first, CAST(p.second AS INTEGER) AS second, round(p.r, 6) AS r FROM pairs WHERE abs(p.r) > 0.5""",
)
def correlated_columns(spark, sf_dir):
    many = views._over(spark, _MANY, lineitem=views.table(spark, sf_dir, "lineitem"))
    return correlation.correlated_columns(many, _COLUMNS, 0.5).withColumn("r", F.round("r", 6))


_FEWER = ["supplier", "flag", "month"]


@query(
    "correlated_categories",
    f"""{_dictionary_sql(_FEWER)},
    n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM wide), one AS (SELECT k, CAST(count(*) AS DOUBLE) AS c FROM ones GROUP BY k),
    pairs AS (SELECT x.k AS first, y.k AS second, coalesce(two.c, 0) AS c, x.c AS cx, y.c AS cy FROM one x JOIN one y ON x.k < y.k
      LEFT JOIN (SELECT a.k AS ka, b.k AS kb, count(*) AS c FROM ones a JOIN ones b ON a.row_id = b.row_id AND a.k < b.k GROUP BY 1, 2) two
        ON two.ka = x.k AND two.kb = y.k)
    SELECT CAST(first AS INTEGER) AS first, CAST(second AS INTEGER) AS second, round(r, 6) AS r
    FROM (SELECT first, second, (n * c - cx * cy) / sqrt(cx * (n - cx) * cy * (n - cy)) AS r FROM pairs, n) WHERE abs(r) > 0.05""",
)
def correlated_categories(spark, sf_dir):
    wide = _wide(spark, sf_dir)
    model = sparse.SparseOneHot(_FEWER).fit(wide)
    return correlation.correlated_entries(model.entries(wide), model.size, "entries", 0.05).withColumn("r", F.round("r", 6))


# --- rules as a table ---------------------------------------------------------------

# One rule for most parts, pairs of part and supplier that were shipped, a flag, and a rule on a column that is not there.
_RULES = """
SELECT row_number() OVER (ORDER BY names, v0, v1) AS rank, names, v0, v1 FROM (
  SELECT DISTINCT 'part' AS names, 'part-' || l_partkey AS v0, '' AS v1 FROM lineitem WHERE l_partkey % 10 = 3
  UNION ALL SELECT DISTINCT 'part,supplier', 'part-' || l_partkey, 'supplier-' || l_suppkey FROM lineitem WHERE l_quantity < 12
  UNION ALL SELECT DISTINCT 'flag', l_returnflag || l_linestatus, '' FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 49
  UNION ALL SELECT 'land', '1', '' UNION ALL SELECT 'absent', 'x', '') AS found
"""
_RULE_SQL = f"""WITH wide AS ({_WIDE}), base AS (SELECT wide.*, CASE WHEN row_id % 1000 = 1 THEN 1 ELSE 0 END AS land FROM wide), rules AS ({_RULES}),
matches AS (SELECT row_id, rank FROM base JOIN rules ON names = 'part' AND part = v0
  UNION ALL SELECT row_id, rank FROM base JOIN rules ON names = 'part,supplier' AND part = v0 AND supplier = v1
  UNION ALL SELECT row_id, rank FROM base JOIN rules ON names = 'flag' AND flag = v0
  UNION ALL SELECT row_id, rank FROM base JOIN rules ON names = 'land' AND land = 1)"""


def _rows_and_rules(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = _wide(spark, sf_dir).withColumn("land", F.when(F.col("row_id") % 1000 == 1, 1).otherwise(0))
    rules = views._over(spark, _RULES, lineitem=views.table(spark, sf_dir, "lineitem"))
    values = F.filter(F.array("v0", "v1"), lambda v: v != "")
    return rows, rules.select(F.col("rank").cast("bigint").alias("rank"), F.split("names", ",").alias("columns"), values.alias("values"))


@query("rule_table_hits", f"{_RULE_SQL} SELECT row_id, CAST(row_id IN (SELECT row_id FROM matches) AS INTEGER) AS sig FROM base")
def rule_table_hits(spark, sf_dir):
    rows, rules = _rows_and_rules(spark, sf_dir)
    return with_rule_hits(rows, rules).select("row_id", "sig")


@query("rule_table_matches", f"{_RULE_SQL} SELECT row_id, rank FROM matches")
def rule_table_matches(spark, sf_dir):
    rows, rules = _rows_and_rules(spark, sf_dir)
    return rule_matches(rows, rules, "row_id")
