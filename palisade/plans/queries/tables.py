"""Sources, sinks, row expressions and profiling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.functions import cells
from palisade.operators import profile
from palisade.plans import views
from palisade.plans.queries.registry import WITH_BIN, WITH_CONN, WITH_DOCS, WITH_FULL, WITH_SCORES, query
from palisade.schema import column_kinds
from palisade.session import scratch_path
from palisade.sources import connections, runs

# --- sources and sinks ---------------------------------------------------------


@query("csv_with_header", f"{WITH_CONN} SELECT * FROM conn")
def csv_with_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    conn = views.conn(spark, sf_dir)
    path = connections.write_table(conn, scratch_path(spark, "csv"))
    return connections.read_table(spark, path, conn.schema)


@query("parquet_table", f"{WITH_CONN} SELECT * FROM conn")
def parquet_table(spark, sf_dir):
    path = connections.write_table(views.conn(spark, sf_dir), scratch_path(spark, "parquet"), fmt="parquet")
    return spark.read.parquet(path)


def _headerless(spark: SparkSession, sf_dir: str, columns: int) -> str:
    full = views.full_conn(spark, sf_dir)
    path = scratch_path(spark, f"headerless{columns}")
    full.select(*full.columns[:columns]).write.csv(path)
    return path


@query("headerless_connections", f"{WITH_FULL} SELECT * FROM full_conn")
def headerless_connections(spark, sf_dir):
    return connections.read_connections(spark, _headerless(spark, sf_dir, 43))


@query("sniffed_headerless", f"{WITH_FULL} SELECT * EXCLUDE (difficulty) FROM full_conn")
def sniffed_headerless(spark, sf_dir):
    return connections.sniff_connections(spark, _headerless(spark, sf_dir, 42))


@query("sniffed_header", f"{WITH_FULL} SELECT * EXCLUDE (label, difficulty) FROM full_conn")
def sniffed_header(spark, sf_dir):
    features = views.full_conn(spark, sf_dir).drop("label", "difficulty")
    return connections.sniff_connections(spark, connections.write_table(features, scratch_path(spark, "header")))


# Every 101st record has lost its end, every 103rd has a word where a number belongs.
_DAMAGED = """SELECT CASE WHEN l_partkey % 101 = 5 THEN l_orderkey || ',' || l_partkey
  WHEN l_partkey % 103 = 7 THEN l_orderkey || ',' || l_partkey || ',many,' || l_linenumber
  ELSE l_orderkey || ',' || l_partkey || ',' || l_suppkey || ',' || l_linenumber END AS line, l_orderkey, l_partkey, l_suppkey, l_linenumber
FROM lineitem"""


def _quarantined(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    path = scratch_path(spark, "damaged")
    views._over(spark, _DAMAGED, lineitem=views.table(spark, sf_dir, "lineitem")).select("line").write.text(path)
    return connections.read_with_rejects(spark, path, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int", most=0.05)


@query(
    "rows_beside_rejects",
    f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM ({_DAMAGED}) WHERE l_partkey % 101 <> 5 AND l_partkey % 103 <> 7",
)
def rows_beside_rejects(spark, sf_dir):
    return _quarantined(spark, sf_dir)[0]


@query("rejected_lines", f"SELECT line FROM ({_DAMAGED}) WHERE l_partkey % 101 = 5 OR l_partkey % 103 = 7")
def rejected_lines(spark, sf_dir):
    return _quarantined(spark, sf_dir)[1]


@query(
    "prepared_connections",
    f"""{WITH_FULL}
    SELECT part, * EXCLUDE (part, label, difficulty), CASE WHEN label = 'normal' THEN 0 ELSE 1 END AS label
    FROM full_conn, (VALUES ('train'), ('test')) AS parts(part)""",
)
def prepared_connections(spark, sf_dir):
    raw = _headerless(spark, sf_dir, 43)
    train, test = connections.prepare_connections(spark, raw, raw, scratch_path(spark, "prepared"))
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "last_run_summary",
    f"""{WITH_SCORES}
    SELECT 'run-2' AS run_id, 'classes' AS section, CAST(y AS VARCHAR) || '.n' AS key,
           CAST(count(*) AS VARCHAR) AS value
    FROM scores GROUP BY y""",
)
def last_run_summary(spark, sf_dir):
    path = scratch_path(spark, "runs")
    scored = views.scores(spark, sf_dir)
    for run_id, column in (("run-1", "sig"), ("run-2", "y")):
        table = scored.groupBy(F.col(column).alias("class")).agg(F.count(F.lit(1)).alias("n"))
        for _ in range(2):  # a repeated append leaves one copy
            runs.append_summary(runs.summary_rows(run_id, "classes", table, key="class"), path)
    return runs.last_summary(spark, path)


# --- row expressions -----------------------------------------------------------


@query(
    "column_kinds",
    """SELECT * FROM (VALUES ('row_id','numeric'), ('duration','numeric'), ('land','numeric'),
      ('src_bytes','numeric'), ('dst_bytes','numeric'), ('serror_rate','numeric'), ('rerror_rate','numeric'),
      ('same_srv_rate','numeric'), ('num_outbound_cmds','numeric'), ('protocol_type','categorical'),
      ('service','categorical'), ('flag','categorical'), ('label','categorical')) AS kinds("column", kind)""",
)
def kinds_of_columns(spark, sf_dir):
    return column_kinds(views.conn(spark, sf_dir))


@query("binary_label", f"{WITH_BIN} SELECT row_id, label FROM bin")
def binary_label(spark, sf_dir):
    return cells.with_binary_label(views.conn(spark, sf_dir)).select("row_id", "label")


@query("feature_projection", f"{WITH_CONN} SELECT * EXCLUDE (label) FROM conn")
def feature_projection(spark, sf_dir):
    return cells.without(views.conn(spark, sf_dir), "label", "difficulty")


_UNCLEAN = """SELECT row_id, dst_bytes,
  CASE WHEN duration = 1 THEN CAST('Infinity' AS DOUBLE) WHEN duration = 2 THEN CAST('-Infinity' AS DOUBLE)
       WHEN duration = 3 THEN CAST('NaN' AS DOUBLE) ELSE src_bytes END AS src_bytes
FROM conn"""


@query(
    "finite_cells",
    f"""{WITH_CONN}, unclean AS ({_UNCLEAN})
    SELECT row_id, CASE WHEN isfinite(src_bytes) THEN src_bytes ELSE 0.0 END AS src_bytes,
           coalesce(dst_bytes, 0.0) AS dst_bytes FROM unclean""",
)
def finite_cells(spark, sf_dir):
    unclean = spark.sql(_UNCLEAN.replace("FROM conn", "FROM {conn}"), conn=views.conn(spark, sf_dir))
    return cells.finite_table(unclean, ["src_bytes", "dst_bytes"])


@query(
    "aligned_features",
    f"""{WITH_CONN} SELECT row_id, serror_rate, CAST(0 AS DOUBLE) AS srv_count, src_bytes FROM conn""",
)
def aligned_features(spark, sf_dir):
    return cells.align(views.conn(spark, sf_dir), ["serror_rate", "srv_count", "src_bytes"], keep=("row_id",))


@query("threshold_decision", f"{WITH_SCORES} SELECT row_id, CAST(p_a >= 0.5 AS INT) AS decision FROM scores")
def threshold_decision(spark, sf_dir):
    return views.scores(spark, sf_dir).select("row_id", cells.decide(F.col("p_a"), 0.5).alias("decision"))


@query(
    "verdicts",
    f"""{WITH_SCORES} SELECT row_id, CASE WHEN p_a >= 0.5 THEN 'Attack' ELSE 'Normal' END AS verdict,
      CASE WHEN y = 1 THEN 'Attack' ELSE 'Normal' END AS actual FROM scores""",
)
def verdicts(spark, sf_dir):
    return views.scores(spark, sf_dir).select(
        "row_id",
        cells.verdict(cells.decide(F.col("p_a"), 0.5)).alias("verdict"),
        cells.verdict(F.col("y")).alias("actual"),
    )


@query("scoring_preview", f"{WITH_CONN} SELECT * FROM conn ORDER BY row_id, src_bytes, dst_bytes NULLS FIRST LIMIT 100")
def scoring_preview(spark, sf_dir):
    return cells.first_rows(views.conn(spark, sf_dir), 100, "row_id", "src_bytes", "dst_bytes")


# --- profiling -----------------------------------------------------------------


@query(
    "table_shape",
    f"""{WITH_CONN} SELECT 'shape' AS section, 'rows' AS key, count(*) AS value FROM conn
    UNION ALL SELECT * FROM (VALUES ('shape', 'columns', 13), ('dtypes', 'bigint', 1), ('dtypes', 'int', 3),
      ('dtypes', 'double', 5), ('dtypes', 'string', 4)) AS facts(section, key, value)""",
)
def table_shape(spark, sf_dir):
    return profile.table_shape(views.conn(spark, sf_dir))


_COLUMNS = """row_id duration protocol_type service flag land src_bytes dst_bytes serror_rate rerror_rate
same_srv_rate num_outbound_cmds label""".split()
_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, count(*) AS n FROM conn" for c in _COLUMNS
)


@query("missing_counts", f'{WITH_CONN} SELECT "column", missing_count FROM ({_MISSING})')
def missing_counts(spark, sf_dir):
    return profile.missing_counts(views.conn(spark, sf_dir))


@query(
    "missing_report",
    f"""{WITH_CONN} SELECT "column", missing_count, round(missing_count * 100.0 / n, 2) AS missing_percent
    FROM ({_MISSING}) WHERE missing_count > 0""",
)
def missing_report(spark, sf_dir):
    return profile.missing_report(views.conn(spark, sf_dir))


@query(
    "duplicate_rows",
    f"""{WITH_CONN} SELECT (SELECT count(*) FROM conn) - count(*) AS duplicate_rows
    FROM (SELECT DISTINCT * EXCLUDE (row_id, src_bytes) FROM conn)""",
)
def duplicate_rows(spark, sf_dir):
    return profile.duplicate_rows(views.conn(spark, sf_dir).drop("row_id", "src_bytes"))


_DISTRIBUTION = """SELECT {c} AS class, count(*) AS count,
  round(count(*) * 100.0 / (SELECT count(*) FROM {t}), 2) AS percentage,
  (SELECT max(n) / min(n) FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY {c}))
    AS balance_ratio
FROM {t} WHERE {c} IS NOT NULL GROUP BY {c}"""


@query("class_distribution", f"{WITH_CONN} {_DISTRIBUTION.format(c='label', t='conn')}")
def class_distribution(spark, sf_dir):
    return profile.class_distribution(views.conn(spark, sf_dir), "label")


@query("class_distribution_with_nulls", f"{WITH_CONN} {_DISTRIBUTION.format(c='flag', t='conn')}")
def class_distribution_with_nulls(spark, sf_dir):
    return profile.class_distribution(views.conn(spark, sf_dir), "flag")


@query("document_classes", f"{WITH_DOCS} {_DISTRIBUTION.format(c='toxic', t='docs')}")
def document_classes(spark, sf_dir):
    return profile.class_distribution(views.labelled_documents(spark, sf_dir), "toxic")


def _summary_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS std,
        CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 9) AS q25,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 9) AS q50, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 9) AS q75,
        CAST(max({c}) AS DOUBLE) AS max FROM {table}"""
        for c in columns
    )


def _rounded_summary(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: F.round(c, d) for c, d in (("mean", 5), ("std", 5), ("q25", 9), ("q50", 9), ("q75", 9))}
    )


_NUMBERS = "duration land src_bytes dst_bytes serror_rate rerror_rate same_srv_rate num_outbound_cmds".split()


@query("numeric_summary", f"{WITH_CONN} {_summary_sql('conn', _NUMBERS)}")
def numeric_summary(spark, sf_dir):
    return _rounded_summary(profile.numeric_summary(views.conn(spark, sf_dir), _NUMBERS))


@query("order_summary", _summary_sql("orders", ["o_totalprice"]))
def order_summary(spark, sf_dir):
    return _rounded_summary(profile.numeric_summary(views.table(spark, sf_dir, "orders"), ["o_totalprice"]))


@query(
    "exploration",
    f"""{WITH_CONN} SELECT 'classes' AS section, count(DISTINCT label) AS n FROM conn
    UNION ALL SELECT 'shape', 6 UNION ALL SELECT 'missing', 2 UNION ALL SELECT 'duplicates', 1
    UNION ALL SELECT 'columns', 13 UNION ALL SELECT 'statistics', 9""",
)
def exploration(spark, sf_dir):
    tables = profile.explore(views.conn(spark, sf_dir), "label")
    counted = [
        t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("section"), "n") for name, t in tables.items()
    ]
    result = counted[0]
    for part in counted[1:]:
        result = result.unionByName(part)
    return result


@query(
    "batch_verdict_totals",
    f"""{WITH_SCORES} SELECT CASE WHEN p_a >= 0.5 THEN 'Attack' ELSE 'Normal' END AS verdict, count(*) AS n
    FROM scores GROUP BY 1""",
)
def batch_verdict_totals(spark, sf_dir):
    decided = views.scores(spark, sf_dir).select(cells.verdict(cells.decide(F.col("p_a"), 0.5)).alias("verdict"))
    return decided.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))
