"""Connection-like views of the given tables.  Each text is valid Spark SQL and DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from palisade.schema import CONNECTION_COLUMNS

ROW_ID = "((l_orderkey * 100000 + l_partkey) * 10000 + l_suppkey) * 10 + l_linenumber"

CONN = f"""
SELECT {ROW_ID} AS row_id,
  l_linenumber AS duration,
  CASE WHEN l_partkey % 10 < 6 THEN 'tcp' WHEN l_partkey % 10 < 9 THEN 'udp' ELSE 'icmp' END AS protocol_type,
  CASE l_suppkey % 4 WHEN 0 THEN 'http' WHEN 1 THEN 'ftp' WHEN 2 THEN 'private' ELSE 'smtp' END AS service,
  CASE WHEN l_linenumber = 3 AND l_quantity = 7 THEN NULL WHEN l_orderkey % 10 < 7 THEN 'SF'
       WHEN l_orderkey % 10 < 9 THEN 'S0' ELSE 'REJ' END AS flag,
  CASE WHEN l_partkey % 100 = 7 THEN 1 ELSE 0 END AS land,
  l_extendedprice AS src_bytes,
  CASE WHEN l_linenumber = 7 AND l_quantity > 45 THEN NULL ELSE l_quantity END AS dst_bytes,
  l_discount AS serror_rate, l_tax AS rerror_rate,
  CAST(1 AS DOUBLE) - l_discount AS same_srv_rate,
  0 AS num_outbound_cmds,
  CASE WHEN l_orderkey % 10 IN (7, 8) THEN 'syn_flood'
       WHEN l_partkey % 100 = 7 THEN 'land_loop'
       WHEN l_suppkey % 4 = 2 AND l_partkey % 10 = 9 THEN 'icmp_private'
       WHEN l_orderkey % 10 = 9 AND NOT (l_quantity = 50 AND l_partkey % 10 < 6) THEN 'reject_scan'
       WHEN l_quantity = 13 THEN 'unknown' ELSE 'normal' END AS label
FROM lineitem
"""

SCORES = """
SELECT row_id, CASE WHEN label <> 'normal' THEN 1 ELSE 0 END AS y,
  CASE WHEN (flag IS NOT NULL AND flag = 'S0') OR land = 1 THEN 1 ELSE 0 END AS sig,
  ROUND(serror_rate * 10, 6) AS p_a,
  ROUND(rerror_rate * CAST(12.5 AS DOUBLE), 6) AS p_b,
  ROUND(duration / CAST(7 AS DOUBLE), 6) AS p_c
FROM conn
"""

# Columns of the full layout that the small view does not have.
_DERIVED = {
    "src_bytes": "l_partkey * 17 % 5000",
    "dst_bytes": "CAST(l_quantity AS BIGINT) * 100",
    "duration": "CAST(l_linenumber AS BIGINT)",
    "hot": "l_partkey % 7",
    "logged_in": "CAST(l_orderkey % 2 AS INT)",
    "root_shell": "CASE WHEN l_partkey % 500 = 3 THEN 1 ELSE 0 END",
    "is_guest_login": "CASE WHEN l_suppkey % 9 = 1 THEN 1 ELSE 0 END",
    "count": "l_suppkey % 511",
    "srv_count": "l_partkey % 511",
    "dst_host_count": "l_orderkey % 256",
    "dst_host_srv_count": "l_partkey % 256",
    "serror_rate": "l_discount",
    "srv_serror_rate": "l_discount / CAST(2 AS DOUBLE)",
    "rerror_rate": "l_tax",
    "srv_rerror_rate": "l_tax / CAST(2 AS DOUBLE)",
    "same_srv_rate": "CAST(1 AS DOUBLE) - l_discount",
    "dst_host_serror_rate": "(l_discount + l_tax) / CAST(2 AS DOUBLE)",
    "difficulty": "CAST(l_linenumber + 10 AS INT)",
}
_SHARED = ("protocol_type", "service", "flag", "land", "label")
_ZERO = {
    "su_attempted": "CAST(0 AS INT)",
    "is_host_login": "CAST(0 AS INT)",
}


def _full_column(name: str) -> str:
    if name in _SHARED:
        return f"c_{name} AS {name}"
    if name in _DERIVED:
        return f"{_DERIVED[name]} AS {name}"
    if name in _ZERO:
        return f"{_ZERO[name]} AS {name}"
    return f"CAST(0 AS {'DOUBLE' if name.endswith('_rate') else 'BIGINT'}) AS {name}"


_CASES = {
    "protocol_type": "CASE WHEN l_partkey % 10 < 6 THEN 'tcp' WHEN l_partkey % 10 < 9 THEN 'udp' ELSE 'icmp' END",
    "service": "CASE l_suppkey % 4 WHEN 0 THEN 'http' WHEN 1 THEN 'ftp' WHEN 2 THEN 'private' ELSE 'smtp' END",
    "flag": "CASE WHEN l_orderkey % 10 < 7 THEN 'SF' WHEN l_orderkey % 10 < 9 THEN 'S0' ELSE 'REJ' END",
    "land": "CASE WHEN l_partkey % 100 = 7 THEN 1 ELSE 0 END",
    "label": "CASE WHEN l_orderkey % 10 IN (7, 8) THEN 'syn_flood' WHEN l_partkey % 100 = 7 THEN 'land_loop' "
    "WHEN l_quantity = 13 THEN 'unknown' ELSE 'normal' END",
}
FULL_CONN = (
    "SELECT "
    + ", ".join(_full_column(c) for c in CONNECTION_COLUMNS)
    + " FROM (SELECT *, "
    + ", ".join(f"{sql} AS c_{name}" for name, sql in _CASES.items())
    + " FROM lineitem) AS source"
)

LABELLED_DOCUMENTS = """
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _over(spark: SparkSession, text: str, **sources: DataFrame) -> DataFrame:
    for name in sources:
        text = text.replace(f"FROM {name}", f"FROM {{{name}}}").replace(f"JOIN {name}", f"JOIN {{{name}}}")
    return spark.sql(text, **sources)


def conn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over(spark, CONN, lineitem=table(spark, sf_dir, "lineitem"))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over(spark, SCORES, conn=conn(spark, sf_dir))


def full_conn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over(spark, FULL_CONN, lineitem=table(spark, sf_dir, "lineitem"))


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over(
        spark,
        LABELLED_DOCUMENTS,
        documents=table(spark, sf_dir, "documents"),
        labels=table(spark, sf_dir, "labels"),
    )
