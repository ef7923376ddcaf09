"""The checks on trained detectors notice what does not hold."""

from pyspark.sql import functions as F

from palisade.operators import evaluate, profile
from palisade.plans.queries.holding import _metrics_apart


def _scored(spark):
    rows = [(1, 1, 0.9), (1, 0, 0.4), (0, 0, 0.2), (0, 1, 0.8), (0, 0, 0.1), (1, 1, 0.7)]
    return spark.createDataFrame(rows, "y int, guess int, p double")


def test_right_metrics_have_nothing_odd(spark):
    scored = _scored(spark)
    row = _metrics_apart(evaluate.metrics(scored, "y", "guess", "p"), scored, "y", "guess").first()
    assert (row.n, row.attacks, row.odd) == (6, 3, 0)


def test_each_wrong_metric_is_counted(spark):
    scored = _scored(spark)
    told = evaluate.metrics(scored, "y", "guess", "p")
    wrong = told.withColumn("recall", F.col("recall") + 0.001).withColumn("f1", F.lit(None).cast("double"))
    assert _metrics_apart(wrong, scored, "y", "guess").first().odd == 2
    assert _metrics_apart(told.withColumn("roc_auc", F.lit(1.5)), scored, "y", "guess").first().odd == 1


def test_no_positive_guess_and_no_attack(spark):
    scored = spark.createDataFrame([(0, 0, 0.2), (0, 0, 0.3)], "y int, guess int, p double")
    told = evaluate.metrics(scored, "y", "guess", "p").withColumn("roc_auc", F.lit(0.5))
    row = _metrics_apart(told, scored, "y", "guess").first()
    assert (row.n, row.attacks, row.odd) == (2, 0, 0)


def test_overview_lists_every_column(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.5, None, [1]), (None, None, float("nan"), True, None)], "n int, s string, x double, flag boolean, `a.b` array<int>"
    )
    found = {r["column"]: (r["type"], r["kind"], r["present"], r["missing"]) for r in profile.column_overview(df).collect()}
    assert found == {
        "n": ("int", "numeric", 1, 1),
        "s": ("string", "categorical", 1, 1),
        "x": ("double", "numeric", 1, 1),
        "flag": ("boolean", "other", 1, 1),
        "a.b": ("array<int>", "other", 1, 1),
    }


def test_overview_of_an_empty_table(spark):
    df = spark.createDataFrame([], "n int, s string")
    assert [(r["column"], r["present"], r["missing"]) for r in profile.column_overview(df).collect()] == [("n", 0, 0), ("s", 0, 0)]
