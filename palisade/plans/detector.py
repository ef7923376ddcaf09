"""The two-tier detector: training, scoring, reporting, saving."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.config import DetectorSettings, EnsembleSettings, FusionSettings
from palisade.functions.cells import confidence, verdict
from palisade.operators import evaluate
from palisade.operators.ensemble import ensemble_summary, fusion_report, with_fusion, with_votes
from palisade.operators.features import FeatureEngineer, FeatureModel, assemble
from palisade.operators.learners import FEATURES, FITTERS, fit_learners, learner_importance, score_with
from palisade.operators.preprocess import PreprocessModel, Preprocessor
from palisade.operators.signatures import SignatureMiner, SignatureModel
from palisade.schema import quoted
from palisade.session import cut_lineage
from palisade.sources.artifacts import names_below, new_version, publish, version_folder, versions
from palisade.sources.runs import summary_rows


@dataclass
class Detector:
    preprocess: PreprocessModel
    features: FeatureModel
    learners: dict[str, Model]
    ensemble: EnsembleSettings
    signatures: SignatureModel | None = None
    threshold: float = 0.5

    def prepared(self, df: DataFrame) -> DataFrame:
        """Replay preprocessing and feature selection and assemble the feature vector."""
        table = self.features.transform(self.preprocess.transform(df))
        selected = self.features.output_columns
        return assemble(table, selected, FEATURES).drop(*selected)

    def score(self, df: DataFrame, threshold: float | None = None) -> DataFrame:
        """The input rows with every score on them; one pass, rows are neither lost nor added.

        Signatures look at the raw columns, the learners at the prepared ones.  Added:
        ``sig``, ``p_<model>``, ``pred_<model>``, ``p_ensemble``, ``vote``, ``p_attack``,
        ``prediction``, ``verdict``, ``confidence``.
        """
        limit = self.threshold if threshold is None else float(threshold)
        hit = self.signatures.hit(df).cast("int") if self.signatures is not None else F.lit(0)
        carried = df.select(
            F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("_raw"),
            hit.alias("sig"),
            *[F.col(quoted(c)) for c in self.preprocess.input_columns],
        )
        scored = score_with(self.learners, self.prepared(carried)).drop(FEATURES)
        fused = with_fusion(with_votes(scored, list(self.learners), self.ensemble), "sig", "p_ensemble", limit)
        return fused.withColumns(
            {"verdict": verdict(F.col("prediction")), "confidence": confidence(F.col("p_attack"))}
        ).select("_raw.*", *[F.col(quoted(c)) for c in fused.columns if c != "_raw"], "verdict", "confidence")

    def predict(self, df: DataFrame, model: str = "ensemble") -> DataFrame:
        """The input rows with the labels of the detector, of one learner, or of all of them."""
        scored = self.score(df)
        raw = [F.col(quoted(c)) for c in df.columns]
        if model == "ensemble":
            return scored.select(*raw, "prediction", "p_attack")
        if model == "all":
            return scored.select(*raw, *[f"{k}_{m}" for m in self.learners for k in ("pred", "p")])
        if model not in self.learners:
            raise ValueError(f"no model {model!r}")
        return scored.select(*raw, F.col(f"pred_{model}").alias("prediction"), F.col(f"p_{model}").alias("p_attack"))

    def summary(self, spark: SparkSession) -> DataFrame:
        rules = self.signatures.rule_count if self.signatures is not None else None
        return ensemble_summary(spark, list(self.learners), self.ensemble, self.threshold, rules)


@dataclass
class TrainingRun:
    detector: Detector
    results: dict[str, DataFrame] = field(default_factory=dict)
    scored_validation: DataFrame | None = None
    scored_test: DataFrame | None = None
    n_train: int | None = None


class Preparation:
    """The steps of a training job before its learners.  Each is done when it is first asked for, and once.

    Rules and learners do not depend on each other: rules are mined on the de-duplicated rows, a learner is fitted on
    ``vectors``.  A job that needs one of them can take it from here.
    """

    def __init__(self, train: DataFrame, settings: DetectorSettings | None = None, row_id: str = "row_id", label: str = "label"):
        self.settings = settings or DetectorSettings()
        self.row_id, self.label = row_id, label
        self.train = cut_lineage(train, "train")  # a split is a lazy filter, and preparing takes several passes

    @cached_property
    def n_train(self) -> int:
        return self.train.count()

    @cached_property
    def _fitted(self) -> tuple[PreprocessModel, DataFrame]:
        return Preprocessor(self.settings.preprocess, self.row_id, self.label).fit_rows(self.train)

    @property
    def preprocess(self) -> PreprocessModel:
        return self._fitted[0]

    @cached_property
    def signatures(self) -> SignatureModel | None:
        """The first tier, or None where the settings have none."""
        if not self.settings.fusion.use_signatures:
            return None
        return SignatureMiner(self.settings.signatures, self.label).fit(self._fitted[1])

    @cached_property
    def _clean(self) -> DataFrame:
        return self.preprocess.transform(self._fitted[1])

    @cached_property
    def features(self) -> FeatureModel:
        return FeatureEngineer(self.settings.features, self.row_id, self.label).fit(self._clean)

    @cached_property
    def vectors(self) -> DataFrame:
        """The prepared rows, dealt evenly once, since every learner passes over them a hundred times or more."""
        tasks = self.train.sparkSession.sparkContext.defaultParallelism
        selected = self.features.output_columns
        vectors = assemble(self.features.transform(self._clean), selected, FEATURES).drop(*selected)
        return cut_lineage(vectors.repartition(tasks), "vectors")

    def learners(self, names: tuple[str, ...], trained: dict[str, Model] | None = None) -> dict[str, Model]:
        """The named learners; those in ``trained`` are reused as they are."""
        trained = trained or {}
        if all(n in trained for n in names):
            return {n: trained[n] for n in names}
        return fit_learners(
            self.vectors, self.settings.learners, label=self.label, row_id=self.row_id, names=names, trained=trained
        )

    def detector(self, names: tuple[str, ...], trained: dict[str, Model] | None = None) -> Detector:
        s = self.settings
        return Detector(
            self.preprocess, self.features, self.learners(names, trained), s.ensemble, self.signatures, s.fusion.threshold
        )


def train_detector(
    train: DataFrame | Preparation,
    *,
    validation: DataFrame | None = None,
    test: DataFrame | None = None,
    settings: DetectorSettings | None = None,
    row_id: str = "row_id",
    label: str = "label",
    learners: tuple[str, ...] | None = None,
    trained: dict[str, Model] | None = None,
) -> TrainingRun:
    """Train both tiers on ``train`` (0/1 label), choose the threshold on ``validation``.

    The test rows are only scored.  Each of the three tables is scored or prepared once and
    every result is derived from that.  Learners in ``trained`` (fitted on the same prepared
    features) are reused, and so are the steps of a :class:`Preparation` in place of the training
    rows; that one has its own settings.
    """
    if not isinstance(train, Preparation):
        train = Preparation(train, settings, row_id, label)
    row_id, label = train.row_id, train.label
    names = learners or tuple(FITTERS)
    detector = train.detector(names, trained)
    signatures = detector.signatures
    run = TrainingRun(detector, n_train=train.n_train)
    kept = [row_id, label, "sig", *[f"{k}_{m}" for m in names for k in ("p", "pred")], "p_ensemble", "p_attack"]

    def scored(df: DataFrame) -> DataFrame:
        return cut_lineage(detector.score(df).select(*kept), "scored")

    def decided(df: DataFrame) -> DataFrame:
        return with_fusion(df, "sig", "p_ensemble", detector.threshold)

    if validation is not None:
        run.scored_validation = scored(validation)
        best = evaluate.best_threshold(run.scored_validation, label, "p_attack", "f1")
        detector.threshold = float(best.first()["threshold"])
        run.scored_validation = decided(run.scored_validation)
        run.results["Validation"] = evaluate.metrics(run.scored_validation, label, "prediction", "p_attack")
        run.results["ValidationThreshold"] = best.select("threshold", F.col("value").alias("f1"))
    if test is not None:
        run.scored_test = decided(scored(test))
        models = {m: (F.col(f"pred_{m}"), F.col(f"p_{m}")) for m in names}
        run.results["Models"] = evaluate.compare_models(run.scored_test, label, models)
        final = "HybridFusion" if signatures is not None else "Ensemble"
        run.results[final] = evaluate.metrics(run.scored_test, label, "prediction", "p_attack")
        if signatures is not None:
            run.results["FusionReport"] = fusion_report(
                run.scored_test, "sig", "p_ensemble", detector.threshold, label
            )
    return run


def batch_report(scored: DataFrame, label: str | None = None) -> dict[str, DataFrame]:
    """Totals by verdict of a scored table and, with 0/1 labels, its metrics."""
    report = {"totals": scored.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))}
    if label is not None:
        report["metrics"] = evaluate.metrics(scored, label, "prediction", "p_attack")
    return report


def with_actual(scored: DataFrame, label: str) -> DataFrame:
    return scored.withColumn("actual", verdict(F.col(quoted(label))))


def run_summary(run: TrainingRun, run_id: str, label: str = "label") -> DataFrame:
    """A training run as long rows for the run store: results, sizes, report, curve points, importances."""
    parts = [
        summary_rows(run_id, name, table, key="model" if "model" in table.columns else None)
        for name, table in run.results.items()
    ]
    scored = run.scored_test if run.scored_test is not None else run.scored_validation
    sizes = {"n_train": run.n_train, "n_test": None if run.scored_test is None else run.scored_test.count()}
    spark = SparkSession.active()
    parts.append(summary_rows(run_id, "sizes", spark.createDataFrame([tuple(sizes.values())], ", ".join(f"{c} bigint" for c in sizes))))
    if scored is not None:
        report = evaluate.classification_report(scored, label, "prediction")
        parts.append(summary_rows(run_id, "report", report, key="class"))
        curve = evaluate.roc_curve(scored, label, "p_attack")
        parts += [
            summary_rows(run_id, "classes", evaluate.class_chart(scored, label), key="class"),
            summary_rows(run_id, "confusion", evaluate.confusion_matrix(scored, label, "prediction"), key="actual"),
            summary_rows(run_id, "roc", curve, key="threshold"),
        ]
    names = run.detector.features.output_columns
    for name, model in run.detector.learners.items():
        importance = learner_importance(model, names, spark)
        if importance is not None:
            top = evaluate.importance_chart(importance)
            parts.append(summary_rows(run_id, f"importance of {name}", top, key="feature"))
    summary = parts[0]
    for part in parts[1:]:
        summary = summary.unionByName(part)
    return summary


# --- artifacts ----------------------------------------------------------------


def _write_json(spark: SparkSession, record: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.text(path)


def _read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def save_detector(detector: Detector, spark: SparkSession, path: str) -> str:
    """Write a new version below ``path``, one folder per part and the rules as a readable table; gives its name.

    Readers see it when all of it is there; versions before it stay.
    """
    name, folder = new_version(spark, path)
    detector.preprocess.write().save(f"{folder}/preprocess")
    detector.features.write().save(f"{folder}/features")
    for model_name, model in detector.learners.items():
        PipelineModel([model]).write().save(f"{folder}/learners/{model_name}")
    if detector.signatures is not None:
        detector.signatures.write().save(f"{folder}/signatures")
        detector.signatures.rules(spark).coalesce(1).write.parquet(f"{folder}/rules")
    _write_json(spark, {"threshold": detector.threshold}, f"{folder}/threshold")
    _write_json(
        spark,
        {
            "learners": list(detector.learners),
            "ensemble": asdict(detector.ensemble),
            "signatures": detector.signatures is not None,
        },
        f"{folder}/manifest",
    )
    publish(spark, path, name)
    return name


def stored_threshold(spark: SparkSession, path: str, version: str | None = None) -> float:
    """The tuned threshold of a saved detector, or the default when none was stored."""
    if version is None and not versions(spark, path):
        return FusionSettings().threshold
    try:
        return float(_read_json(spark, f"{version_folder(spark, path, version)}/threshold")["threshold"])
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return FusionSettings().threshold


def load_detector(spark: SparkSession, path: str, version: str | None = None) -> Detector:
    """A saved detector, of the newest version unless one is named; all parts are of that version."""
    folder = version_folder(spark, path, version)
    version = folder.rpartition("/")[2]
    manifest = _read_json(spark, f"{folder}/manifest")
    weights = manifest["ensemble"]["weights"]
    return Detector(
        PreprocessModel.load(f"{folder}/preprocess"),
        FeatureModel.load(f"{folder}/features"),
        {m: PipelineModel.load(f"{folder}/learners/{m}").stages[0] for m in manifest["learners"]},
        EnsembleSettings(manifest["ensemble"]["voting"], tuple(weights) if weights else None),
        SignatureModel.load(f"{folder}/signatures") if manifest["signatures"] else None,
        stored_threshold(spark, path, version),
    )


def list_artifacts(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """(artifact) names of what is stored of a detector, in the newest version unless one is named."""
    folder = version_folder(spark, path, version)
    tops = names_below(spark, folder, folders=True)
    names = [n for t in tops for n in ([f"{t}/{m}" for m in names_below(spark, f"{folder}/{t}", folders=True)] if t == "learners" else [t])]
    return spark.createDataFrame([(n,) for n in sorted(names)], "artifact string")


def list_versions(spark: SparkSession, path: str) -> DataFrame:
    """(version, threshold) of every published version, oldest first."""
    rows = [(v, stored_threshold(spark, path, v)) for v in versions(spark, path)]
    return spark.createDataFrame(rows, "version string, threshold double")


def score_table(spark: SparkSession, path: str, df: DataFrame, threshold: float | None = None) -> DataFrame:
    """Batch inference with a saved detector; its stored threshold applies unless one is given."""
    return load_detector(spark, path).score(df, threshold)
