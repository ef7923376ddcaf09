"""Nearest-neighbour information, stored quantile sketches, and alerts per event-time window."""

from __future__ import annotations

from pyspark.sql import functions as F

from palisade.operators import features, neighbours, sketches
from palisade.operators.neighbours import NEIGHBOURS
from palisade.plans import views
from palisade.plans.queries.preparing import _FINITE, _SCORED, labelled, rounded
from palisade.plans.queries.registry import WITH_CONN, query
from palisade.session import cut_lineage, scratch_path
from palisade.streaming.alerts import alert_counts, follow_alerts, latest_counts

# --- information by nearest neighbours --------------------------------------------


def _psi(n: str) -> str:
    z = f"(CAST({n} AS DOUBLE) + 6)"
    steps = " - ".join(f"1 / (CAST({n} AS DOUBLE) + {i})" for i in range(6))
    return f"(ln({z}) - 0.5 / {z} - 1 / (12 * {z} ^ 2) + 1 / (120 * {z} ^ 4) - 1 / (252 * {z} ^ 6) + 1 / (240 * {z} ^ 8) - {steps})"


def _neighbours_sql(cells: str) -> str:
    """Windows over each class for the neighbours, as-of joins with running counts for the rows in between."""
    k = NEIGHBOURS
    steps = [f"{f}({{}}, {i}) OVER w" for i in range(1, k + 1) for f in ("lag", "lead")]
    beside = ", ".join(f"{s.format('x')} AS x{j}, {s.format('n')} AS n{j}" for j, s in enumerate(steps))
    lists = ", ".join(f"[abs(x - x{j}) FOR i IN range(CASE WHEN n{j} IS NULL THEN 0 ELSE least(n{j}, {k}) END)]" for j in range(2 * k))
    own = f"[0.0::DOUBLE FOR i IN range(least(n - 1, {k}))]"
    return f"""cells AS (SELECT feature, y, x, count(*) AS n FROM ({cells}) WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY feature, y, x),
    sized AS (SELECT * FROM (SELECT *, sum(n) OVER (PARTITION BY feature, y) AS c FROM cells) WHERE c > 1),
    beside AS (SELECT *, least(c - 1, {k}) AS k, {beside} FROM sized WINDOW w AS (PARTITION BY feature, y ORDER BY x)),
    near AS (SELECT feature, x, n, c, k, list_sort(flatten([{own}, {lists}]))[CAST(k AS BIGINT)] AS r FROM beside),
    marks AS (SELECT feature AS f, x AS v, sum(n) AS here, sum(sum(n)) OVER (PARTITION BY feature ORDER BY x) AS upto FROM sized GROUP BY feature, x),
    ends AS (SELECT *, x - r AS low, x + r AS high FROM near),
    met AS (SELECT e.*, a.upto AS below FROM ends e ASOF LEFT JOIN marks a ON e.feature = a.f AND e.high > a.v),
    both_ends AS (SELECT m.*, a.upto AS before FROM met m ASOF LEFT JOIN marks a ON m.feature = a.f AND m.low >= a.v),
    closer AS (SELECT b.*, CASE WHEN b.r = 0 THEN s.here ELSE greatest(b.below - coalesce(b.before, 0), b.n) END AS m
      FROM both_ends b JOIN marks s ON s.f = b.feature AND s.v = b.x)
    SELECT feature, round(greatest({_psi('sum(n)')} + sum(n * ({_psi('k')} - {_psi('c')} - {_psi('m')})) / sum(n), 0), 6) AS score
    FROM closer GROUP BY feature"""


def _cells(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, label AS y, CAST({c} AS DOUBLE) AS x FROM {table}" for c in columns)


@query("neighbour_information", f"{_FINITE}, {_neighbours_sql(_cells('finite', _SCORED))}")
def neighbour_information(spark, sf_dir):
    return rounded(features.ranked_importance(labelled(spark, sf_dir), _SCORED, "label", "mutual_info_neighbours"))


# Prices spread by the class, cells that are missing, and the classes themselves as given.
_SPREAD = ["price", "gap", "per_unit"]
_SPREAD_ROWS = f"""{WITH_CONN}, spread AS (SELECT label, src_bytes + CASE WHEN label = 'normal' THEN 20000 ELSE 0 END AS price,
  dst_bytes - duration AS gap, src_bytes / nullif(dst_bytes, 0) AS per_unit FROM conn)"""


@query("neighbour_information_many_classes", f"{_SPREAD_ROWS}, {_neighbours_sql(_cells('spread', _SPREAD))}")
def neighbour_information_many_classes(spark, sf_dir):
    rows = views.conn(spark, sf_dir).select(
        "label",
        (F.col("src_bytes") + F.when(F.col("label") == "normal", 20000).otherwise(0)).alias("price"),
        (F.col("dst_bytes") - F.col("duration")).alias("gap"),
        (F.col("src_bytes") / F.nullif("dst_bytes", F.lit(0))).alias("per_unit"),
    )
    return rounded(neighbours.neighbour_information(rows, _SPREAD, "label"))


# --- stored sketches -----------------------------------------------------------------

_SKETCHED = ["l_quantity", "l_extendedprice", "l_discount"]
_SHARES = [0.05, 0.25, 0.5, 0.75, 0.95]


@query(
    "sketched_quantiles",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS probability, count({c}) AS n, true AS inside FROM lineitem" for c in _SKETCHED for p in _SHARES
    ),
)
def sketched_quantiles(spark, sf_dir):
    """One sketch per column and line number, stored, merged; whether the rank of each quantile is within the error."""
    rows = views.table(spark, sf_dir, "lineitem")
    parts = cut_lineage(sketches.column_sketches(rows, _SKETCHED, by=("l_linenumber",)), "sketches")
    found = sketches.sketched_quantiles(sketches.merged_sketches(parts), _SHARES).collect()  # 15 numbers
    error = 2 * sketches.rank_error()  # the error at 99 % confidence, doubled: a rerun never fails by chance
    ranks = [
        F.struct(
            F.lit(r["column"]).alias("column"), F.lit(r["probability"]).alias("probability"), F.lit(r["n"]).cast("bigint").alias("n"),
            F.avg((F.col(r["column"]) < r["value"]).cast("int")).alias("below"),
            F.avg((F.col(r["column"]) <= r["value"]).cast("int")).alias("upto"),
        )
        for r in found
    ]
    ranked = rows.agg(F.array(*ranks).alias("ranks")).select(F.inline("ranks"))
    inside = (F.col("below") - error <= F.col("probability")) & (F.col("probability") <= F.col("upto") + error)
    return ranked.select("column", "probability", "n", inside.alias("inside"))


# --- alerts in a stream -----------------------------------------------------------------


@query(
    "streamed_alert_counts",
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS alerts, max(value) AS peak
    FROM events WHERE event_type = 'error' OR value > 150 GROUP BY date_trunc('hour', ts), event_type""",
)
def streamed_alert_counts(spark, sf_dir):
    """Events arrive in three parts by time; each run goes on from the state of the one before."""
    events = views.table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    arrived, output, progress = (scratch_path(spark, n) for n in ("arrived", "alerts", "progress"))
    spark.createDataFrame([], events.schema).write.parquet(arrived)
    third = events.agg(((F.max(F.unix_date(F.to_date("ts"))) - F.min(F.unix_date(F.to_date("ts")))) / 3 + 1).cast("int"), F.min(F.unix_date(F.to_date("ts")))).first()
    part = F.least(F.floor((F.unix_date(F.to_date("ts")) - F.lit(third[1])) / F.lit(third[0])), F.lit(2))
    alert = (F.col("event_type") == "error") | (F.col("value") > 150)
    for i in range(3):
        arriving = events.filter(F.lit(False)) if third[0] is None else events.filter(part == i)
        arriving.write.mode("append").parquet(arrived)
        stream = spark.readStream.schema(events.schema).parquet(arrived)
        follow_alerts(alert_counts(stream, alert, time="ts", group="event_type", value="value"), output, progress).awaitTermination()
    counts = latest_counts(spark, output, "event_type")
    return counts.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))
