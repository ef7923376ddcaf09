"""Evaluation as aggregations over a scored table: y and prediction are 0/1, score in [0, 1].

The functions that take ``by`` evaluate every group (for instance every model) in the same pass.

A null or NaN score says nothing: such a row reaches no threshold and is left out of the curves and of
the AUC, while the counts, which only need the prediction, have it.  Infinite scores are ordinary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.config import (
    CLASS_NAMES,
    THRESHOLD_GRID_HIGH,
    THRESHOLD_GRID_LOW,
    THRESHOLD_GRID_SIZE,
    TOP_IMPORTANCES,
)
from palisade.functions.cells import ratio
from palisade.operators.running import running_totals
from palisade.schema import quoted

THRESHOLD_METRICS = ("f1", "precision", "recall")


def _score_table(
    df: DataFrame, y: str, score: str, by: tuple[str, ...] = (), prediction: str | None = None
) -> DataFrame:
    """Positives and negatives per distinct score: the only shuffle that grows with the table.

    Rows without a score are the row of the null score.
    """
    positive = F.col(quoted(y)).cast("bigint")
    aggregates = [F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg")]
    if prediction is not None:
        flagged = F.col(quoted(prediction)).cast("bigint")
        aggregates += [F.sum(positive * flagged).alias("tp"), F.sum((1 - positive) * flagged).alias("fp")]
    value = F.col(quoted(score)).cast("double")
    return df.groupBy(*by, F.when(~F.isnan(value), value).alias("score")).agg(*aggregates)


def _auc() -> Column:
    """Chance that a positive outscores a negative, draws counting half."""
    below = F.col("neg_before").cast("double") + F.col("neg") / 2.0
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return F.try_divide(F.sum(F.col("pos") * below), pairs)


def roc_auc(df: DataFrame, y: str, score: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, roc_auc); null where only one class occurs."""
    scored = _score_table(df, y, score, by).filter(F.col("score").isNotNull())
    return running_totals(scored, "score", ["neg"], by=by).groupBy(*by).agg(_auc().alias("roc_auc"))


def _rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    return {
        "accuracy": ratio(tp + tn, tp + fp + fn + tn),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
    }


def _evaluated(df: DataFrame, y: str, prediction: str, score: str, by: tuple[str, ...]) -> DataFrame:
    table = _score_table(df, y, score, by, prediction)
    known = F.col("score").isNotNull()
    table = table.withColumns({"all_pos": F.col("pos"), "all_neg": F.col("neg"),
                               "pos": F.when(known, F.col("pos")).otherwise(0), "neg": F.when(known, F.col("neg")).otherwise(0)})
    counts = {
        "tp": F.sum("tp"), "fp": F.sum("fp"), "fn": F.sum("all_pos") - F.sum("tp"), "tn": F.sum("all_neg") - F.sum("fp"),
    }
    ordered = running_totals(table, "score", ["neg"], by=by)
    return ordered.groupBy(*by).agg(*[F.coalesce(c, F.lit(0)).alias(k) for k, c in counts.items()], _auc().alias("roc_auc"))


def metrics(df: DataFrame, y: str, prediction: str, score: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, accuracy, precision, recall, f1, roc_auc)."""
    rates = _rates(*[F.col(c) for c in ("tp", "fp", "fn", "tn")])
    return _evaluated(df, y, prediction, score, by).select(
        *by, *[c.alias(name) for name, c in rates.items()], "roc_auc"
    )


def metrics_summary(df: DataFrame, y: str, prediction: str, score: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The metrics plus sensitivity, specificity and the four counts."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    rates = _rates(tp, fp, fn, tn)
    return _evaluated(df, y, prediction, score, by).select(
        *by,
        *[c.alias(name) for name, c in rates.items()],
        "roc_auc",
        ratio(tp, tp + fn).alias("sensitivity"),
        ratio(tn, tn + fp).alias("specificity"),
        "tn",
        "fp",
        "fn",
        "tp",
    )


def long_scores(df: DataFrame, y: str, models: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One row per row and model: (model, y, prediction, score)."""
    entries = [
        F.struct(F.lit(name).alias("model"), prediction.cast("int").alias("prediction"), score.cast("double").alias("score"))
        for name, (prediction, score) in models.items()
    ]
    return df.select(F.col(quoted(y)).alias("y"), F.inline(F.array(*entries)))


def compare_models(df: DataFrame, y: str, models: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(model, metrics...) of several models in one pass over the scored table."""
    return metrics(long_scores(df, y, models), "y", "prediction", "score", by=("model",))


def stack_results(results: dict[str, DataFrame]) -> DataFrame:
    """One row per named one-row result; a metric that a result lacks is null."""
    stacked = None
    for name, frame in results.items():
        named = frame.select(F.lit(name).alias("model"), "*")
        stacked = named if stacked is None else stacked.unionByName(named, allowMissingColumns=True)
    if stacked is None:
        raise ValueError("no results to compare")
    return stacked


def confusion_matrix(df: DataFrame, y: str, prediction: str) -> DataFrame:
    """(actual, predicted_0, predicted_1), one row per class that is true or predicted anywhere."""
    cells = df.groupBy(F.col(quoted(y)).cast("int").alias("t"), F.col(quoted(prediction)).cast("int").alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    nothing = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("t").alias("actual"), F.when(F.col("p") == 0, F.col("n")).otherwise(0).alias("zero"),
                 F.when(F.col("p") == 1, F.col("n")).otherwise(0).alias("one"), F.lit(True).alias("true")),
        F.struct(F.col("p").alias("actual"), nothing.alias("zero"), nothing.alias("one"), F.lit(False).alias("true")),
    )
    return (
        cells.select(F.inline(sides))
        .filter(F.col("true") | F.col("actual").isNotNull())
        .groupBy("actual")
        .agg(F.sum("zero").alias("predicted_0"), F.sum("one").alias("predicted_1"))
        .orderBy("actual")
    )


def confusion_cells(df: DataFrame, y: str, prediction: str) -> DataFrame:
    """(actual, predicted, n) for any number of classes: the pairs that occur, and the diagonal of every class.

    A class that is only true or only predicted has a diagonal of 0.  A missing label or prediction is a class.
    """
    pairs = df.groupBy(F.col(quoted(y)).alias("actual"), F.col(quoted(prediction)).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(0).cast("bigint")
    cells = F.array(
        F.struct("actual", "predicted", "n"),
        F.struct("actual", F.col("actual").alias("predicted"), none.alias("n")),
        F.struct(F.col("predicted").alias("actual"), "predicted", none.alias("n")),
    )
    return pairs.select(F.inline(cells)).groupBy("actual", "predicted").agg(F.sum("n").alias("n"))


def _per_class(df: DataFrame, y: str, prediction: str) -> DataFrame:
    """(class, tp, support, predicted) from the class-pair counts."""
    cells = df.groupBy(F.col(quoted(y)).alias("t"), F.col(quoted(prediction)).alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    sides = F.array(
        F.struct(
            F.col("t").alias("class"),
            F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0).alias("tp"),
            F.col("n").alias("support"),
            F.lit(0).cast("bigint").alias("predicted"),
        ),
        F.struct(
            F.col("p").alias("class"),
            F.lit(0).cast("bigint").alias("tp"),
            F.lit(0).cast("bigint").alias("support"),
            F.col("n").alias("predicted"),
        ),
    )
    return (
        cells.select(F.inline(sides))
        .filter(F.col("class").isNotNull())
        .groupBy("class")
        .agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("predicted").alias("predicted"))
    )


def _class_rates() -> dict[str, Column]:
    tp, support, predicted = F.col("tp"), F.col("support"), F.col("predicted")
    return {
        "precision": ratio(tp, predicted),
        "recall": ratio(tp, support),
        "f1": ratio(2 * tp, support + predicted),
    }


def per_class_metrics(df: DataFrame, y: str, prediction: str, classes: DataFrame) -> DataFrame:
    """(class, precision, recall, f1) one against the rest, for every class of a code table.

    ``classes`` holds (value, code); a class without a row or prediction scores 0.
    """
    found = _per_class(df, y, prediction).withColumnRenamed("class", "code")
    listed = classes.select("code", F.col("value").alias("class"))
    return listed.join(found, "code", "left").select(
        "class", *[F.coalesce(c, F.lit(0.0)).alias(name) for name, c in _class_rates().items()]
    )


def classification_report(
    df: DataFrame, y: str, prediction: str, names: dict[int, str] | None = None
) -> DataFrame:
    """(class, precision, recall, f1, support) per class, then accuracy, macro and weighted means."""
    names = names if names is not None else CLASS_NAMES
    shown = F.col("class").cast("string")
    for code, name in names.items():
        shown = F.when(F.col("class") == code, name).otherwise(shown)
    classes = _per_class(df, y, prediction).select(
        shown.alias("class"), *[c.alias(k) for k, c in _class_rates().items()], "support", "tp"
    )
    rates = ("precision", "recall", "f1")
    # Grouping by (class) and by () gives the class rows and the overall row in one pass.
    rolled = classes.rollup("class").agg(
        *[F.avg(k).alias(f"macro_{k}") for k in rates],
        *[F.coalesce(F.try_divide(F.sum(F.col(k) * F.col("support")), F.sum("support")), F.lit(0.0)).alias(f"mean_{k}") for k in rates],
        F.coalesce(F.try_divide(F.sum("tp"), F.sum("support")), F.lit(0.0)).alias("accuracy"),
        F.sum("support").alias("support"),
        F.grouping("class").alias("overall"),
    )

    def line(title: Column, *values: Column) -> Column:
        return F.struct(title.alias("class"), *[v.alias(k) for v, k in zip(values, rates)], F.col("support"))

    macro = [F.col(f"macro_{k}") for k in rates]
    lines = F.when(
        F.col("overall") == 1,
        F.array(
            line(F.lit("accuracy"), *[F.col("accuracy")] * 3),
            line(F.lit("macro avg"), *macro),
            line(F.lit("weighted avg"), *[F.col(f"mean_{k}") for k in rates]),
        ),
    ).otherwise(F.array(line(F.col("class"), *macro)))
    return rolled.select(F.inline(lines))


def roc_curve(
    df: DataFrame, y: str, score: str, by: tuple[str, ...] = (), *, drop_collinear: bool = True
) -> DataFrame:
    """(by, threshold, fpr, tpr) from the strictest threshold down, starting at (inf, 0, 0).

    A point on a straight line between its neighbours is left out: there the next score adds the
    same number of positives and of negatives as this one.
    """
    table = running_totals(
        _score_table(df, y, score, by).filter(F.col("score").isNotNull()),
        "score",
        ["pos", "neg"],
        by=by,
        descending=True,
        look_ahead=True,
        totals=True,
    )
    strictest = (F.col("pos_before") == 0) & (F.col("neg_before") == 0)
    straight = (F.col("pos") == F.col("pos_next")) & (F.col("neg") == F.col("neg_next"))
    if drop_collinear:
        table = table.filter(strictest | ~F.coalesce(straight, F.lit(False)))

    def point(threshold: Column, fp: Column, tp: Column) -> Column:
        return F.struct(
            threshold.alias("threshold"),
            F.try_divide(fp.cast("double"), F.col("neg_total")).alias("fpr"),
            F.try_divide(tp.cast("double"), F.col("pos_total")).alias("tpr"),
        )

    here = point(F.col("score"), F.col("neg_before") + F.col("neg"), F.col("pos_before") + F.col("pos"))
    start = point(F.lit(float("inf")), F.lit(0), F.lit(0))
    return table.select(*by, F.inline(F.when(strictest, F.array(start, here)).otherwise(F.array(here))))


def precision_recall_curve(df: DataFrame, y: str, score: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, threshold, precision, recall) per distinct score, closed by (null, 1, 0)."""
    table = running_totals(
        _score_table(df, y, score, by).filter(F.col("score").isNotNull()),
        "score",
        ["pos", "neg"],
        by=by,
        descending=True,
        totals=True,
    )
    tp = F.col("pos_before") + F.col("pos")
    flagged = tp + F.col("neg_before") + F.col("neg")

    def point(threshold: Column, precision: Column, recall: Column) -> Column:
        return F.struct(threshold.alias("threshold"), precision.alias("precision"), recall.alias("recall"))

    recall = F.coalesce(F.try_divide(tp.cast("double"), F.col("pos_total")), F.lit(1.0))
    here = point(F.col("score"), ratio(tp, flagged), recall)
    end = point(F.lit(None).cast("double"), F.lit(1.0), F.lit(0.0))
    strictest = (F.col("pos_before") == 0) & (F.col("neg_before") == 0)
    return table.select(*by, F.inline(F.when(strictest, F.array(here, end)).otherwise(F.array(here))))


def threshold_grid() -> list[float]:
    """The evenly spaced thresholds that are tried; the last one is the upper end itself."""
    step = (THRESHOLD_GRID_HIGH - THRESHOLD_GRID_LOW) / (THRESHOLD_GRID_SIZE - 1)
    inner = [THRESHOLD_GRID_LOW + i * step for i in range(THRESHOLD_GRID_SIZE - 1)]
    return [*inner, THRESHOLD_GRID_HIGH]


def threshold_sweep(df: DataFrame, y: str, score: str, metric: str = "f1") -> DataFrame:
    """(threshold, value) over the whole grid.

    Each score is reduced to the number of thresholds it reaches (a missing score reaches none), so the
    table is read once and at most a hundred counts remain.
    """
    if metric not in THRESHOLD_METRICS:
        raise ValueError(f"unknown metric {metric!r}")
    grid = threshold_grid()
    positive = F.col(quoted(y)).cast("bigint")
    value = F.col(quoted(score)).cast("double")
    steps_reached = F.size(F.filter(F.array(*[F.lit(t) for t in grid]), lambda t: t <= value))
    reached = df.select(F.when(value.isNull() | F.isnan(value), 0).otherwise(steps_reached).alias("reached"), positive.alias("pos"))
    counts = reached.groupBy("reached").agg(
        F.sum("pos").alias("pos"), F.sum(1 - F.col("pos")).alias("neg")
    )
    steps = df.sparkSession.createDataFrame(
        [(0, None), *[(i + 1, t) for i, t in enumerate(grid)]], "reached int, threshold double"
    )
    upward = Window.orderBy(F.desc("reached"))
    whole = Window.orderBy(F.desc("reached")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summed = steps.join(counts, "reached", "left").select(
        "threshold",
        F.coalesce(F.sum("pos").over(upward), F.lit(0)).alias("tp"),
        F.coalesce(F.sum("neg").over(upward), F.lit(0)).alias("fp"),
        F.coalesce(F.sum("pos").over(whole), F.lit(0)).alias("positives"),
    )
    tp, fp, positives = F.col("tp"), F.col("fp"), F.col("positives")
    result = {
        "f1": ratio(2 * tp, tp + fp + positives),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, positives),
    }[metric]
    return summed.filter(F.col("threshold").isNotNull()).select("threshold", result.alias("value"))


def best_threshold(df: DataFrame, y: str, score: str, metric: str = "f1") -> DataFrame:
    """(threshold, value) of the best grid threshold; the smallest one among equals."""
    return threshold_sweep(df, y, score, metric).orderBy(F.desc("value"), F.asc("threshold")).limit(1)


def class_chart(df: DataFrame, y: str) -> DataFrame:
    """(class, count, percentage with one decimal)."""
    counts = df.groupBy(F.col(quoted(y)).alias("class")).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.select("class", "count", F.round(F.col("count") * 100.0 / total, 1).alias("percentage"))


def importance_chart(scores: DataFrame, top: int = TOP_IMPORTANCES) -> DataFrame:
    """The leading (feature, score) rows of an importance table."""
    return scores.orderBy(F.desc("score"), "feature").limit(top)


def metric_bars(comparison: DataFrame) -> DataFrame:
    """(model, metric, value) of a model comparison, for grouped bars."""
    shown = [c for c in ("accuracy", "precision", "recall", "f1", "roc_auc") if c in comparison.columns]
    return comparison.unpivot(["model"], shown, "metric", "value")
