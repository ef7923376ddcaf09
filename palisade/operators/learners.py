"""The five classifiers as distributed pyspark.ml training jobs.

Every learner adds ``p_<name>`` (attack probability) and ``pred_<name>`` (its own 0/1 label).
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml import Model, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LinearSVC, LinearSVCModel, LogisticRegression, RandomForestClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.config import (
    BoostedTreesSettings,
    FineBinnedTreesSettings,
    ForestSettings,
    KernelMachineSettings,
    LearnerSettings,
    LogisticSettings,
)
from palisade.functions.draws import hashed_draw
from palisade.operators.evaluate import metrics
from palisade.operators.fitted import HasState
from palisade.operators.margins import EVERYTHING, Cosines, feature_blocks, fit_machines, margins_outside
from palisade.operators.sampling import with_class_weight
from palisade.schema import quoted
from palisade.session import cut_lineage, side_by_side, use_checkpoints

FEATURES = "features"
ROWS_PER_TASK = 150_000
FOREST_ROWS_PER_TASK = 20_000  # each of them goes down all trees in a pass
MACHINE_ROWS_PER_TASK = 40_000  # each of them takes its cosines in a pass


def more_tasks(df: DataFrame, rows: int, worth: int) -> DataFrame:
    """A task per ``worth`` rows, up to the cluster's cores, where ``df`` comes in fewer.

    A written table is read back in tasks of so many bytes, and a million prepared rows may be one or two of these.
    """
    wanted = min(df.sparkSession.sparkContext.defaultParallelism, -(-rows // worth))
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def few_tasks(df: DataFrame, rows: int, worth: int = ROWS_PER_TASK) -> DataFrame:
    """No more tasks than ``rows`` are worth: a fit of a thousand passes starts them all again in each of these.

    Tasks grow with the rows, up to those that ``df`` has or the cluster has cores.
    """
    return more_tasks(df, rows, worth).coalesce(max(1, -(-rows // worth)))


def _output_columns(name: str) -> dict[str, str]:
    return {
        "rawPredictionCol": f"_{name}_raw",
        "probabilityCol": f"_{name}_probability",
        "predictionCol": f"_{name}_prediction",
    }


def _named(estimator, name: str):
    """Give a classifier output columns of its own, so that several can run on one frame."""
    columns = _output_columns(name)
    return (
        estimator.setRawPredictionCol(columns["rawPredictionCol"])
        .setProbabilityCol(columns["probabilityCol"])
        .setPredictionCol(columns["predictionCol"])
    )


def fit_boosted_trees(train: DataFrame, name: str, s: BoostedTreesSettings, label: str, row_id: str) -> Model:
    trees = GBTClassifier(
        featuresCol=FEATURES,
        labelCol=label,
        maxIter=s.trees,
        maxDepth=s.depth,
        stepSize=s.learning_rate,
        subsamplingRate=s.subsample,
        featureSubsetStrategy=str(s.column_sample),
        maxBins=s.max_bins,
        seed=s.seed,
        maxMemoryInMB=1024,
    )
    return _named(trees, name).fit(few_tasks(train, train.count()))


def fit_fine_binned_trees(train: DataFrame, name: str, s: FineBinnedTreesSettings, label: str, row_id: str) -> Model:
    trees = GBTClassifier(
        featuresCol=FEATURES,
        labelCol=label,
        maxIter=s.trees,
        maxDepth=s.depth,
        stepSize=s.learning_rate,
        subsamplingRate=1.0,
        featureSubsetStrategy=str(s.column_sample),
        maxBins=s.max_bins,
        minInstancesPerNode=s.min_rows_per_leaf,
        seed=s.seed,
        maxMemoryInMB=1024,
    )
    return _named(trees, name).fit(few_tasks(train, train.count()))


def fit_random_forest(train: DataFrame, name: str, s: ForestSettings, label: str, row_id: str) -> Model:
    forest = RandomForestClassifier(
        featuresCol=FEATURES,
        labelCol=label,
        numTrees=s.trees,
        maxDepth=s.depth,
        minInstancesPerNode=s.min_rows_per_leaf,
        featureSubsetStrategy="sqrt",
        seed=s.seed,
        maxMemoryInMB=1024,
        cacheNodeIds=True,  # the same trees; else each level walks every row down all trees again
    )
    train = more_tasks(train, train.count(), FOREST_ROWS_PER_TASK)
    if s.balanced:
        forest = forest.setWeightCol("_weight")
        train = with_class_weight(train, label, "_weight")
    return _named(forest, name).fit(train)


def fit_logistic(train: DataFrame, name: str, s: LogisticSettings, label: str, row_id: str) -> Model:
    n = train.count()
    regression = LogisticRegression(
        featuresCol=FEATURES,
        labelCol=label,
        maxIter=s.max_iterations,
        regParam=1.0 / (s.c * n),
        elasticNetParam=0.0,
        standardization=False,
        family="binomial",
    )
    return _named(regression, name).fit(few_tasks(train, n))


class RandomFourierFeatures(Transformer, HasState):
    """Random cosine features whose inner products approximate the RBF kernel.

    The projection follows from the seed, so nothing but a few numbers is stored or shipped.
    """

    def __init__(self, inputs: int = 1, outputs: int = 1, gamma: float = 1.0, seed: int = 0, name: str = "rbf"):
        super().__init__()
        self.with_state({"inputs": inputs, "outputs": outputs, "gamma": gamma, "seed": seed, "name": name})

    def projection(self) -> tuple[np.ndarray, np.ndarray]:
        """Directions and phases of the cosines."""
        s = self.learned
        draws = np.random.default_rng(s["seed"])
        directions = draws.normal(scale=math.sqrt(2.0 * s["gamma"]), size=(s["inputs"], s["outputs"]))
        return directions, draws.uniform(0.0, 2.0 * math.pi, size=s["outputs"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        s = self.learned
        directions, phases = self.projection()
        height = math.sqrt(2.0 / s["outputs"])

        @F.arrow_udf("array<double>")
        def cosines(rows: pa.Array) -> pa.Array:
            x = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1 if len(rows) else len(directions))
            found = height * np.cos(x @ directions + phases)
            ends = np.arange(0, found.size + 1, found.shape[1], dtype=np.int32)
            return pa.ListArray.from_arrays(ends, found.ravel())

        return dataset.withColumn(f"_{s['name']}_cosines", array_to_vector(cosines(vector_to_array(FEATURES))))


def kernel_width(train: DataFrame) -> tuple[int, float]:
    """Number of features and 1 / (features * variance over all cells)."""
    row = train.select(Summarizer.metrics("mean", "variance", "count").summary(F.col(FEATURES)).alias("s")).first()[0]
    mean, n = row["mean"].toArray(), row["count"]
    population = row["variance"].toArray() * (n - 1) / n if n > 1 else row["variance"].toArray() * 0
    spread = float(np.mean(population + mean**2) - np.mean(mean) ** 2)
    return len(mean), 1.0 / (len(mean) * spread) if spread > 0 else 1.0


def _calibration_rows(margins: DataFrame) -> DataFrame:
    """Two weighted rows per margin, so that the smoothed class targets are fitted exactly."""
    positives, n = margins.agg(F.sum("label"), F.count(F.lit(1))).first()
    positives = int(positives or 0)
    toward_one = (positives + 1.0) / (positives + 2.0)
    toward_zero = 1.0 / (n - positives + 2.0)
    target = F.when(F.col("label") == 1, toward_one).otherwise(toward_zero)
    sides = F.array(
        F.struct(F.lit(1.0).alias("side"), target.alias("weight")),
        F.struct(F.lit(0.0).alias("side"), (1.0 - target).alias("weight")),
    )
    return margins.select(array_to_vector(F.array("margin")).alias("_margin"), F.inline(sides))


def _linear_machine(weights: np.ndarray, intercept: float, settings: dict) -> LinearSVCModel:
    """A fitted LinearSVC of known weights."""
    context = SparkContext._active_spark_context
    uid = LinearSVC().uid
    made = context._jvm.org.apache.spark.ml.classification.LinearSVCModel(uid, _py2java(context, Vectors.dense(weights)), intercept)
    model = LinearSVCModel(made)
    model._resetUid(uid)
    for param, value in settings.items():
        model._set(**{param: value})
    return model


def fit_kernel_machine(train: DataFrame, name: str, s: KernelMachineSettings, label: str, row_id: str) -> Model:
    """RBF kernel machine: random features, linear SVM, calibration on out-of-fold margins.

    The machines of the folds and the final one share each pass, and cosines are computed in it: as a table they would
    take a kilobyte a row.
    """
    width, gamma = kernel_width(train)
    cosines = RandomFourierFeatures(width, s.fourier_features, gamma, s.seed, name)
    fold = F.pmod(hashed_draw(s.seed, F.col(quoted(row_id))), F.lit(s.folds))
    n = train.count()
    blocks = feature_blocks(few_tasks(train, n, MACHINE_ROWS_PER_TASK), FEATURES, label, fold, width)
    drawn = Cosines(*cosines.projection())
    without, counts = [*range(s.folds), EVERYTHING], [n * (1 - 1 / s.folds)] * s.folds + [n]
    *folds, (weights, intercept) = fit_machines(blocks, drawn, without, [1.0 / (s.c * m) for m in counts], s.max_iterations)
    margins = cut_lineage(margins_outside(train.sparkSession, blocks, drawn, folds), "margins")
    rows = margins.count()
    blocks.unpersist()
    columns = _output_columns(name)
    final = _linear_machine(
        weights,
        intercept,
        {
            "featuresCol": f"_{name}_cosines",
            "labelCol": label,
            "rawPredictionCol": columns["rawPredictionCol"],
            "predictionCol": columns["predictionCol"],
            "regParam": 1.0 / (s.c * n),
            "maxIter": s.max_iterations,
            "standardization": False,
        },
    )
    slicer = VectorSlicer(inputCol=columns["rawPredictionCol"], outputCol="_margin", indices=[1])
    calibration = LogisticRegression(
        featuresCol="_margin",
        labelCol="side",
        weightCol="weight",
        rawPredictionCol=f"_{name}_logit",
        probabilityCol=columns["probabilityCol"],
        predictionCol=f"_{name}_likely",
        standardization=False,
    ).fit(few_tasks(_calibration_rows(margins), 2 * rows))
    return PipelineModel([cosines, final, slicer, calibration])


FITTERS: dict[str, Callable[..., Model]] = {
    "boosted_trees": fit_boosted_trees,
    "fine_binned_trees": fit_fine_binned_trees,
    "random_forest": fit_random_forest,
    "kernel_machine": fit_kernel_machine,
    "logistic_regression": fit_logistic,
}


def fit_learners(
    train: DataFrame,
    settings: LearnerSettings | None = None,
    *,
    label: str = "label",
    row_id: str = "row_id",
    names: tuple[str, ...] | None = None,
    trained: dict[str, Model] | None = None,
) -> dict[str, Model]:
    """Fit the named learners on a ``features`` vector; those in ``trained`` are reused as they are."""
    settings = settings or LearnerSettings()
    use_checkpoints(train.sparkSession)  # long boosting runs cut their lineage there
    trained = trained or {}
    names = names or tuple(FITTERS)
    new = [name for name in names if name not in trained]
    fitted = side_by_side(train.sparkSession, [lambda n=n: FITTERS[n](train, n, getattr(settings, n), label, row_id) for n in new])
    found = {**trained, **dict(zip(new, fitted))}
    return {name: found[name] for name in names}


def score_with(models: dict[str, Model], df: DataFrame) -> DataFrame:
    """Add ``p_<name>`` and ``pred_<name>`` of every model."""
    if not models:
        raise ValueError("no trained model")
    for name, model in models.items():
        before = df.columns
        columns = _output_columns(name)
        df = model.transform(df).select(
            *[F.col(quoted(c)) for c in before],
            vector_to_array(columns["probabilityCol"])[1].alias(f"p_{name}"),
            F.col(columns["predictionCol"]).cast("int").alias(f"pred_{name}"),
        )
    return df


def evaluate_learner(models: dict[str, Model], name: str, df: DataFrame, label: str = "label") -> DataFrame:
    """Metrics of one trained learner on a labelled ``features`` table."""
    if name not in models:
        raise ValueError(f"{name} has not been trained")
    scored = score_with({name: models[name]}, df).select(label, f"pred_{name}", f"p_{name}")
    return metrics(cut_lineage(scored, "scored"), label, f"pred_{name}", f"p_{name}")


def learner_importance(model: Model, features: list[str], spark) -> DataFrame | None:
    """(feature, score) for trees and linear models, best first; None for the kernel machine."""
    weights = getattr(model, "featureImportances", None)
    if weights is None:
        weights = getattr(model, "coefficients", None)
    if weights is None:
        return None
    rows = [(c, float(w)) for c, w in zip(features, weights.toArray())]
    return spark.createDataFrame(rows, "feature string, score double").orderBy(F.desc("score"), "feature")
