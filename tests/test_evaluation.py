import math
import random

import pytest
from pyspark.sql import functions as F

from palisade.operators import evaluate
from palisade.operators.running import running_totals


def scored(spark, n=400, levels=None, seed=3):
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        y = int(draw.random() < 0.4)
        p = min(max(draw.gauss(0.4 + 0.2 * y, 0.2), 0.0), 1.0)
        rows.append((y, round(p * levels) / levels if levels else p, int(p > 0.5)))
    return rows, spark.createDataFrame(rows, "y int, p double, pred int").repartition(4)


def auc_by_pairs(rows):
    pos, neg = [p for y, p, _ in rows if y], [p for y, p, _ in rows if not y]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("levels", [None, 7])
def test_auc_equals_all_pairs(spark, levels):
    rows, df = scored(spark, levels=levels)
    assert math.isclose(evaluate.roc_auc(df, "y", "p").first()[0], auc_by_pairs(rows), rel_tol=1e-12)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.7)], "y int, p double")
    assert evaluate.roc_auc(df, "y", "p").first()[0] is None


def test_running_totals_cross_ranges(spark):
    df = spark.range(1000).select((F.col("id") / 1000).alias("s"), F.col("id").alias("v"))
    out = running_totals(df, "s", ["v"], descending=True, look_ahead=True, totals=True)
    for r in out.collect():
        assert r["v_before"] == sum(range(r["v"] + 1, 1000))
        assert r["v_next"] == (r["v"] - 1 if r["v"] else None)
        assert r["v_total"] == 499500


def test_running_totals_in_groups(spark):
    df = spark.range(200).select((F.col("id") % 3).alias("g"), (F.col("id") / 7).alias("s"), F.col("id").alias("v"))
    out = running_totals(df, "s", ["v"], by=("g",))
    for r in out.collect():
        assert r["v_before"] == sum(v for v in range(r["v"]) if v % 3 == r["g"])


def test_roc_curve_against_brute_force(spark):
    rows, df = scored(spark, n=150, levels=40)
    pos, neg = sum(y for y, *_ in rows), sum(1 - y for y, *_ in rows)
    every = [
        (t, sum(p >= t and not y for y, p, _ in rows), sum(p >= t and y for y, p, _ in rows))
        for t in sorted({p for _, p, _ in rows}, reverse=True)
    ]
    bends = [
        q
        for i, q in enumerate(every)
        if i in (0, len(every) - 1)
        or (every[i + 1][1] - 2 * q[1] + every[i - 1][1], every[i + 1][2] - 2 * q[2] + every[i - 1][2]) != (0, 0)
    ]
    got = [tuple(r) for r in evaluate.roc_curve(df, "y", "p").orderBy(F.desc("threshold")).collect()]
    want = [(math.inf, 0.0, 0.0)] + [(t, fp / neg, tp / pos) for t, fp, tp in bends]
    assert len(got) == len(want) < len(every) + 1
    for a, b in zip(got, want):
        assert a == pytest.approx(b)
    full = evaluate.roc_curve(df, "y", "p", drop_collinear=False)
    assert full.count() == len(every) + 1


def test_precision_recall_curve_ends(spark):
    rows, df = scored(spark, n=100)
    curve = evaluate.precision_recall_curve(df, "y", "p").orderBy(F.asc_nulls_last("threshold")).collect()
    assert tuple(curve[-1]) == (None, 1.0, 0.0)
    assert curve[0]["recall"] == 1.0 and len(curve) == len({p for _, p, _ in rows}) + 1


def test_threshold_grid_is_the_known_one():
    grid = evaluate.threshold_grid()
    assert len(grid) == 50 and grid[0] == 0.1 and grid[-1] == 0.9
    assert grid[25] == 0.5081632653061224


@pytest.mark.parametrize("metric", ["f1", "precision", "recall"])
def test_best_threshold_is_the_first_best(spark, metric):
    rows, df = scored(spark, levels=20)
    best = (None, -1.0)
    for t in evaluate.threshold_grid():
        tp = sum(p >= t and y for y, p, _ in rows)
        fp = sum(p >= t and not y for y, p, _ in rows)
        fn = sum(y for y, *_ in rows) - tp
        value = {
            "f1": 2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0,
            "precision": tp / (tp + fp) if tp + fp else 0.0,
            "recall": tp / (tp + fn) if tp + fn else 0.0,
        }[metric]
        if value > best[1]:
            best = (t, value)
    assert tuple(evaluate.best_threshold(df, "y", "p", metric).first()) == pytest.approx(best)


def test_unknown_metric(spark):
    with pytest.raises(ValueError):
        evaluate.best_threshold(spark.createDataFrame([(1, 0.5)], "y int, p double"), "y", "p", "accuracy")


def test_metrics_without_any_positive_prediction(spark):
    df = spark.createDataFrame([(1, 0, 0.1), (0, 0, 0.2)], "y int, pred int, p double")
    row = evaluate.metrics_summary(df, "y", "pred", "p").first().asDict()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (0.5, 0.0, 0.0, 0.0)
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (1, 0, 1, 0)


def test_single_class_summary_gives_zeros(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 1, 0.2)], "y int, pred int, p double")
    row = evaluate.metrics_summary(df, "y", "pred", "p").first().asDict()
    assert row["sensitivity"] == 0.0 and row["specificity"] == 0.5 and row["roc_auc"] is None


def test_classification_report(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1)], "y int, pred int")
    rows = {r["class"]: r for r in evaluate.classification_report(df, "y", "pred").collect()}
    assert set(rows) == {"Normal", "Attack", "accuracy", "macro avg", "weighted avg"}
    assert rows["accuracy"]["f1"] == 0.75 and rows["Normal"]["recall"] == 0.5
    assert rows["macro avg"]["support"] == 4


def test_compare_and_stack(spark):
    rows, df = scored(spark, n=60)
    models = {"m": (F.col("pred"), F.col("p")), "flat": (F.lit(0), F.lit(0.5))}
    both = {r["model"]: r for r in evaluate.compare_models(df, "y", models).collect()}
    assert both["flat"]["roc_auc"] == 0.5
    assert math.isclose(both["m"]["roc_auc"], auc_by_pairs(rows), rel_tol=1e-12)
    stacked = evaluate.stack_results(
        {"a": evaluate.metrics(df, "y", "pred", "p"), "b": spark.createDataFrame([(0.5,)], "threshold double")}
    )
    assert stacked.filter("model = 'b'").first()["accuracy"] is None
    with pytest.raises(ValueError):
        evaluate.stack_results({})


ODD = [(1, 1, 0.9), (0, 0, 0.2), (1, 1, None), (0, 1, None), (0, 0, float("nan")), (1, 1, float("inf")), (0, 0, float("-inf"))]


def test_rows_without_a_score_are_counted(spark):
    df = spark.createDataFrame(ODD, "y int, pred int, p double")
    row = evaluate.metrics_summary(df, "y", "pred", "p").first()
    assert (row["tp"], row["fp"], row["fn"], row["tn"], row["roc_auc"]) == (3, 1, 0, 3, 1.0)
    sweep = {r["threshold"]: r["value"] for r in evaluate.threshold_sweep(df, "y", "p", "recall").collect()}
    assert all(math.isclose(v, 2 / 3) for v in sweep.values())
    assert evaluate.roc_curve(df, "y", "p").count() >= 3


def test_no_rows(spark):
    df = spark.createDataFrame([], "y int, pred int, p double")
    row = evaluate.metrics_summary(df, "y", "pred", "p").first()
    assert (row["tp"], row["fp"], row["fn"], row["tn"], row["roc_auc"]) == (0, 0, 0, 0, None)
    assert evaluate.roc_curve(df, "y", "p").collect() == []
    assert evaluate.confusion_matrix(df, "y", "pred").collect() == []


def test_a_class_that_is_only_predicted_has_a_row(spark):
    df = spark.createDataFrame([(0, 0), (0, 1)], "y int, pred int")
    assert [tuple(r) for r in evaluate.confusion_matrix(df, "y", "pred").collect()] == [(0, 1, 1), (1, 0, 0)]


def test_confusion_of_many_classes(spark):
    rows = [(0, 0), (2, 2), (1, 2), (1, 2), (None, 3)]
    df = spark.createDataFrame(rows, "y int, pred int")
    got = {(r["actual"], r["predicted"]): r["n"] for r in evaluate.confusion_cells(df, "y", "pred").collect()}
    assert got == {(0, 0): 1, (1, 1): 0, (2, 2): 1, (1, 2): 2, (None, 3): 1, (None, None): 0, (3, 3): 0}
    assert evaluate.confusion_cells(df.limit(0), "y", "pred").count() == 0
