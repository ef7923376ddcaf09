import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from palisade.operators.cleaning import outlier_bounds
from palisade.operators.neighbours import _with_radius, digamma, neighbour_information
from palisade.operators.quantiles import exact_quantiles
from palisade.operators.sketches import column_sketches, merged_sketches, rank_error, sketched_quantiles
from palisade.session import scratch_path
from palisade.streaming.alerts import alert_counts, follow_alerts, latest_counts


def psi(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, n))


def brute(rows, k=3):
    rows = [(x, y) for x, y in rows if x is not None and not math.isnan(x) and abs(x) < math.inf and y is not None]
    sizes = {c: sum(y == c for _, y in rows) for _, c in rows}
    rows = [(x, y) for x, y in rows if sizes[y] > 1]
    if not rows:
        return 0.0
    total = 0.0
    for i, (x, y) in enumerate(rows):
        near = sorted(abs(x - a) for j, (a, b) in enumerate(rows) if b == y and j != i)
        found = min(k, len(near))
        r = near[found - 1]
        m = sum((x - r < a < x + r) if r else a == x for a, _ in rows)
        total += psi(found) - psi(sizes[y]) - psi(max(m, 1))
    return max(0.0, psi(len(rows)) + total / len(rows))


def test_digamma(spark):
    for n in (1, 2, 3, 10, 1000):
        assert abs(spark.range(1).select(digamma(F.lit(n))).first()[0] - psi(n)) < 1e-8


@pytest.mark.parametrize("block", [6, 4096])
def test_neighbours_equal_brute_force(spark, block):
    """Blocks of six values carry neighbours over every border."""
    draw = random.Random(5)
    rows = []
    for i in range(240):
        y = draw.choice("aaabbc")
        rows.append((draw.gauss(0, 1) + (y == "a") * 2, float(draw.randint(0, 4)), 7.0, draw.choice([None, math.nan, math.inf, draw.random()]), y))
    rows += [(5.0, 5.0, 7.0, 1.0, "alone"), (5.0, 5.0, 7.0, 1.0, None), (-0.0, 0.0, 7.0, None, "b"), (0.0, -0.0, 7.0, None, "b")]
    names = ["normal", "tied", "same", "gaps"]
    df = spark.createDataFrame(rows, "normal double, tied double, same double, gaps double, label string")
    got = {r.feature: r.score for r in neighbour_information(df, names, "label", block=block).collect()}
    for i, name in enumerate(names):
        assert abs(got[name] - brute([(r[i], r[4]) for r in rows])) < 1e-6, name
    assert got["normal"] > 0.3


def test_distances_are_sorted_without_a_comparing_lambda(spark):
    """A comparing lambda is interpreted for every pair of distances that the sort looks at."""
    cells = spark.range(40).selectExpr("0 AS feature", "0 AS y", "CAST(id * id AS DOUBLE) AS x", "1L AS n", "40L AS of_class")
    met = _with_radius(cells, 3, 16)
    assert "array_sort(" not in met._jdf.queryExecution().optimizedPlan().toString()
    assert {r["x"]: r["r"] for r in met.collect()}[9.0] == 8.0  # 5, 7 and 8 away: 4, 16, 1


def test_neighbours_of_nothing(spark):
    df = spark.createDataFrame([], "x double, label int")
    assert [tuple(r) for r in neighbour_information(df, ["x"], "label").collect()] == [("x", 0.0)]
    with pytest.raises(ValueError, match="block"):
        neighbour_information(df, ["x"], "label", block=2)


def test_sketches_of_parts_merge(spark):
    df = spark.range(20_000).selectExpr("CAST(id AS DOUBLE) AS x", "CAST(NULL AS DOUBLE) AS empty", "id % 7 AS part", "if(id % 5 = 0, NULL, id % 100) AS y")
    merged = merged_sketches(column_sketches(df, ["x", "empty", "y"], by=("part",)))
    rows = {(r.column, r.probability): (r.n, r.value) for r in sketched_quantiles(merged, [0.1, 0.5]).collect()}
    assert {c for c, _ in rows} == {"x", "y"} and rows["y", 0.5][0] == 16_000
    for p in (0.1, 0.5):
        assert rows["x", p][0] == 20_000 and abs(rows["x", p][1] / 20_000 - p) <= 2 * rank_error()


def test_approximate_bounds_lie_near_the_exact_ones(spark):
    df = spark.range(30_000).selectExpr("CAST(id AS DOUBLE) AS x", "CAST(NULL AS DOUBLE) AS empty")
    found = outlier_bounds(df, ["x", "empty"], "iqr", approximate=True)
    assert list(found) == ["x"]
    e = 2 * rank_error()
    a, b, c, d = exact_quantiles(df, ["x"], [0.25 - e, 0.25 + e, 0.75 - e, 0.75 + e])["x"]
    assert a - 1.5 * (d - a) <= found["x"][0] <= b - 1.5 * (c - b)
    assert c + 1.5 * (c - b) <= found["x"][1] <= d + 1.5 * (d - a)


def test_alerts_of_a_stream(spark):
    """A row within the lateness counts, one whose window the watermark has passed does not; reruns change nothing."""
    day = dt.datetime(2024, 1, 1)
    arrived, output, progress = (scratch_path(spark, n) for n in ("arrived", "alerts", "progress"))

    def arrive(*rows):
        events = [(day + dt.timedelta(minutes=m) if m is not None else None, kind, float(v)) for m, kind, v in rows]
        df = spark.createDataFrame(events, "ts timestamp_ntz, kind string, value double")
        df.coalesce(1).write.mode("append").parquet(arrived)
        run(df.schema)

    def run(schema):
        counts = alert_counts(spark.readStream.schema(schema).parquet(arrived), F.col("value") > 5, time="ts", group="kind", value="value")
        follow_alerts(counts, output, progress).awaitTermination()
        return schema

    def found():
        return sorted((r.start.hour, r.kind, r.alerts, r.peak) for r in latest_counts(spark, output, "kind").collect())

    arrive((5, "a", 6), (50, "a", 9), (51, "b", 1), (65, "b", 7), (None, "a", 9))
    assert found() == [(0, "a", 2, 9.0), (1, "b", 1, 7.0)]
    arrive((58, "a", 8))  # the watermark is at 55 minutes
    assert found() == [(0, "a", 3, 9.0), (1, "b", 1, 7.0)]
    arrive((200, "a", 6))
    arrive((59, "a", 50), (130, "b", 50), (185, "b", 6))  # the watermark is at 190 minutes: two are too late
    assert found() == [(0, "a", 3, 9.0), (1, "b", 1, 7.0), (3, "a", 1, 6.0), (3, "b", 1, 6.0)]
    before = found()
    run(spark.read.parquet(arrived).schema)
    assert found() == before
