import math

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from palisade.config import (
    BoostedTreesSettings,
    DetectorSettings,
    EnsembleSettings,
    FeatureSettings,
    FineBinnedTreesSettings,
    ForestSettings,
    FusionSettings,
    KernelMachineSettings,
    LearnerSettings,
    LogisticSettings,
    SignatureSettings,
)
from palisade.operators import learners, margins, sampling
from palisade.operators.ensemble import fusion_report
from palisade.operators.features import assemble
from palisade.operators.preprocess import Preprocessor
from palisade.plans import detector as jobs
from palisade.plans.queries import QUERIES, detecting
from palisade.session import on_all_cores
from palisade.sources import runs
from palisade.sources.artifacts import version_folder, versions
from palisade.sources.connections import write_table
from palisade.streaming.scoring import arriving, score_arriving

# Enough for the 2,000 rows of the fixture; the registered queries train with the defaults.
SHORT = LearnerSettings(
    boosted_trees=BoostedTreesSettings(trees=10, depth=4),
    fine_binned_trees=FineBinnedTreesSettings(trees=10, depth=4),
    random_forest=ForestSettings(trees=15, depth=8),
    kernel_machine=KernelMachineSettings(fourier_features=48, folds=3, max_iterations=30),
    logistic_regression=LogisticSettings(max_iterations=100),
)
SETTINGS = DetectorSettings(learners=SHORT, signatures=SignatureSettings(min_support=0.005, min_confidence=0.9))
PAIR = ("logistic_regression", "random_forest")


@pytest.fixture(scope="module")
def parts(traffic):
    return sampling.three_way_split(traffic, row_id="row_id", label="label")


@pytest.fixture(scope="module")
def run(parts):
    train, validation, test = parts
    return jobs.train_detector(train, validation=validation, test=test, settings=SETTINGS, learners=PAIR)


@pytest.fixture(scope="module")
def vectors(traffic):
    preprocess, rows = Preprocessor().fit_rows(traffic)
    names = preprocess.output_columns
    return assemble(preprocess.transform(rows), names).select("row_id", "label", "features").cache()


@pytest.fixture(scope="module")
def matrix(vectors):
    rows = vectors.select("label", vector_to_array("features").alias("x")).collect()
    return np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows], dtype=float)


def test_steps_of_a_preparation_are_those_of_the_whole_job(spark, run, parts, monkeypatch):
    fitted = []
    monkeypatch.setattr(jobs, "fit_learners", lambda *a, names, **k: fitted.append(names) or learners.fit_learners(*a, names=names, **k))
    prepared = jobs.Preparation(parts[0], SETTINGS)
    assert prepared.signatures.rules(spark).collect() == run.detector.signatures.rules(spark).collect() and not fitted
    alone = prepared.learners(("logistic_regression",))
    assert fitted == [("logistic_regression",)] and list(alone) == ["logistic_regression"]
    assert np.allclose(alone["logistic_regression"].coefficients, run.detector.learners["logistic_regression"].coefficients, atol=1e-9)
    assert prepared.learners(("logistic_regression",), alone) == alone and len(fitted) == 1


def test_a_query_about_one_learner_fits_that_one(spark, monkeypatch):
    fitted = []
    monkeypatch.setattr(detecting, "_trainings", {})
    monkeypatch.setattr(jobs, "fit_learners", lambda *a, names, **k: fitted.append(names) or learners.fit_learners(*a, names=names, **k))
    for name in ("learner_logistic_regression", "learner_importance_linear", "learner_logistic_regression_holdout"):
        assert QUERIES[name](spark, "/root/testdata/sf0.001").count() >= 1
    assert fitted == [("logistic_regression",)]


def test_forest_that_keeps_node_ids_has_the_same_trees(vectors):
    model = learners.fit_random_forest(vectors, "random_forest", SHORT.random_forest, "label", "row_id")
    assert model.getOrDefault("cacheNodeIds")
    weighted = sampling.with_class_weight(vectors, "label", "_weight")
    plain = RandomForestClassifier(labelCol="label", weightCol="_weight", numTrees=15, maxDepth=8, minInstancesPerNode=2, featureSubsetStrategy="sqrt", seed=SHORT.random_forest.seed)
    trees = [m.toDebugString.split("\n", 1)[1] for m in (model, plain.fit(weighted))]
    assert trees[0] == trees[1]


def test_logistic_regression_reaches_the_optimum(vectors, matrix):
    """Newton's method on the same penalised objective gives the same coefficients."""
    x, y = matrix
    ones = np.column_stack([x, np.ones(len(x))])
    penalty = np.append(np.ones(x.shape[1]), 0.0)  # C = 1, the intercept is free
    w = np.zeros(ones.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-ones @ w))
        gradient = ones.T @ (p - y) + penalty * w
        hessian = (ones * (p * (1 - p))[:, None]).T @ ones + np.diag(penalty + 1e-12)
        w -= np.linalg.solve(hessian, gradient)
    model = learners.fit_logistic(vectors, "lr", LogisticSettings(), "label", "row_id")
    assert np.allclose(model.coefficients.toArray(), w[:-1], atol=1e-3)
    assert math.isclose(model.intercept, w[-1], abs_tol=2e-2)


def test_fourier_features_approximate_the_kernel(spark, vectors, matrix):
    x, _ = matrix
    width, gamma = learners.kernel_width(vectors)
    assert width == x.shape[1] and math.isclose(gamma, 1 / (width * x.var()), rel_tol=1e-9)
    stage = learners.RandomFourierFeatures(width, 4000, gamma, 42, "rbf")
    some = vectors.filter("row_id < 30")
    rows = stage.transform(some).select(
        vector_to_array("features").alias("x"), vector_to_array("_rbf_cosines").alias("z")
    ).collect()
    a, z = np.array([r["x"] for r in rows]), np.array([r["z"] for r in rows])
    exact = np.exp(-gamma * ((a[:, None, :] - a[None, :, :]) ** 2).sum(-1))
    assert np.abs(z @ z.T - exact).max() < 0.1


@pytest.mark.parametrize("name", list(learners.FITTERS))
def test_learner(spark, vectors, name):
    models = learners.fit_learners(vectors, SHORT, names=(name,))
    scored = learners.score_with(models, vectors)
    assert scored.count() == 2000
    low, high, labels = scored.agg(F.min(f"p_{name}"), F.max(f"p_{name}"), F.collect_set(f"pred_{name}")).first()
    assert 0.0 <= low < high <= 1.0 and set(labels) <= {0, 1}
    assert learners.evaluate_learner(models, name, vectors).first()["roc_auc"] > 0.9
    names = [f"f{i}" for i in range(vectors.first()["features"].size)]
    importance = learners.learner_importance(models[name], names, spark)
    if name == "kernel_machine":
        assert importance is None
    else:
        assert importance.count() == len(names)


def test_calibrated_probabilities_follow_the_labels(vectors):
    settings = KernelMachineSettings(fourier_features=64, folds=3, max_iterations=30)
    model = learners.fit_kernel_machine(vectors, "k", settings, "label", "row_id")
    scored = learners.score_with({"k": model}, vectors)
    mean_p, mean_y = scored.agg(F.avg("p_k"), F.avg("label")).first()
    assert abs(mean_p - mean_y) < 0.05


def test_trained_learners_are_reused(vectors):
    first = learners.fit_learners(vectors, SHORT, names=("logistic_regression",))
    again = learners.fit_learners(vectors, SHORT, names=PAIR, trained=first)
    assert again["logistic_regression"] is first["logistic_regression"] and list(again) == list(PAIR)


def test_untrained_learner(vectors):
    with pytest.raises(ValueError):
        learners.evaluate_learner({}, "random_forest", vectors)
    with pytest.raises(ValueError):
        learners.score_with({}, vectors)


def test_training_results(run):
    assert list(run.results) == ["Validation", "ValidationThreshold", "Models", "HybridFusion", "FusionReport"]
    assert run.results["HybridFusion"].first()["accuracy"] > 0.9
    assert {r["model"] for r in run.results["Models"].collect()} == set(PAIR)
    tuned = run.results["ValidationThreshold"].first()
    assert run.detector.threshold == tuned["threshold"]
    assert run.results["Validation"].first()["f1"] == pytest.approx(tuned["f1"])
    report = run.results["FusionReport"].first()
    assert report["n_records"] == 400 and 0 < report["n_signature_hits"] <= report["n_flagged"]
    assert report["threshold"] == run.detector.threshold


def test_run_summary_keeps_the_last_run(spark, run, tmp_path):
    path = str(tmp_path / "runs")
    for run_id in ("2024-01", "2024-02"):
        runs.append_summary(jobs.run_summary(run, run_id), path)
    last = runs.last_summary(spark, path)
    assert {r[0] for r in last.select("run_id").distinct().collect()} == {"2024-02"}
    sections = {r[0] for r in last.select("section").distinct().collect()}
    assert {"Models", "confusion", "roc", "classes", "importance of random_forest"} <= sections
    stored = {(r["section"], r["key"]): r["value"] for r in last.collect()}
    assert len(stored) == last.count()
    assert stored["sizes", "n_train"] == str(run.n_train) and stored["sizes", "n_test"] == str(run.scored_test.count())
    assert float(stored["report", "Attack.recall"]) > 0.8


def test_repeated_append_leaves_one_copy(spark, tmp_path):
    path = str(tmp_path / "runs")
    table = spark.createDataFrame([(0, 5), (1, 7)], "class int, n int")
    for run_id in ("a", "b", "a", "a"):
        runs.append_summary(runs.summary_rows(run_id, "classes", table, key="class"), path)
    everything = spark.read.schema(runs.SCHEMA).parquet(path)
    assert dict(everything.groupBy("run_id").count().collect()) == {"a": 2, "b": 2}
    assert {r["run_id"] for r in runs.last_summary(spark, path).collect()} == {"b"}


def test_fusion_beats_the_flat_threshold_when_models_say_normal(run):
    silent = run.scored_test.withColumn("p_ensemble", F.lit(0.0))
    report = fusion_report(silent, "sig", "p_ensemble", 0.5, "label").first()
    flat = silent.agg(F.avg((F.col("label") == 0).cast("double"))).first()[0]
    assert report["n_flagged_by_ensemble_only"] == 0 and report["accuracy"] > flat


def test_without_test_and_validation(parts):
    settings = DetectorSettings(learners=SHORT, fusion=FusionSettings(use_signatures=False))
    run = jobs.train_detector(parts[0], settings=settings, learners=("logistic_regression",))
    assert run.results == {} and run.detector.threshold == 0.5 and run.detector.signatures is None
    scored = run.detector.score(parts[2])
    assert scored.agg(F.max("sig")).first()[0] == 0
    assert scored.filter("p_attack <> p_ensemble").count() == 0


def test_duplicates_and_top_k_train_together(traffic):
    """Labels stay with their rows through de-duplication, so selection by score still works."""
    doubled = traffic.unionByName(traffic.withColumn("row_id", F.col("row_id") + 10_000)).drop("x", "z")
    settings = DetectorSettings(learners=SHORT, features=FeatureSettings(k=3))
    run = jobs.train_detector(doubled, settings=settings, learners=("logistic_regression",))
    assert len(run.detector.features.output_columns) == 3


def test_scoring_keeps_every_row_and_needs_no_shuffle(run, traffic):
    repeated = traffic.unionByName(traffic)
    scored = run.detector.score(repeated)
    assert scored.count() == 4000
    assert scored.columns[: len(traffic.columns)] == traffic.columns
    assert scored.drop("sig").columns[len(traffic.columns)] == "p_logistic_regression"
    plan = run.detector.score(traffic)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_scores_are_consistent(run, traffic):
    scored = run.detector.score(traffic, threshold=0.3)
    wrong = scored.filter(
        ~(
            (F.col("prediction") == F.when(F.col("sig") == 1, 1).otherwise((F.col("p_ensemble") >= 0.3).cast("int")))
            & (F.col("confidence") >= 0.5)
            & (F.col("p_attack") == F.when(F.col("sig") == 1, 0.99).otherwise(F.col("p_ensemble")))
            & (F.col("verdict") == F.when(F.col("prediction") == 1, "Attack").otherwise("Normal"))
        )
    )
    assert wrong.count() == 0


def test_hard_voting_changes_the_vote_not_the_prediction(run, traffic):
    d = run.detector
    hard = jobs.Detector(d.preprocess, d.features, d.learners, EnsembleSettings("hard"), d.signatures, d.threshold)
    a, b = d.score(traffic), hard.score(traffic)
    assert a.agg(F.sum("prediction")).first() == b.agg(F.sum("prediction")).first()
    draws = b.filter("pred_logistic_regression <> pred_random_forest")
    assert draws.filter("vote <> 0").count() == 0


def test_predict_by_name(run, traffic):
    features_only = traffic.drop("label")
    assert run.detector.predict(features_only).columns[-2:] == ["prediction", "p_attack"]
    assert run.detector.predict(features_only, "random_forest").count() == 2000
    every = run.detector.predict(features_only, "all").columns
    assert {f"p_{m}" for m in PAIR} | {f"pred_{m}" for m in PAIR} <= set(every)
    with pytest.raises(ValueError):
        run.detector.predict(features_only, "oracle")


def test_saved_detector_scores_the_same(spark, run, traffic, tmp_path):
    path = str(tmp_path / "detector")
    jobs.save_detector(run.detector, spark, path)
    before = run.detector.score(traffic).orderBy("row_id").collect()
    after = jobs.score_table(spark, path, traffic).orderBy("row_id").collect()
    assert before == after
    assert jobs.stored_threshold(spark, path) == run.detector.threshold
    assert jobs.stored_threshold(spark, str(tmp_path / "nothing")) == 0.5
    listed = {r[0] for r in jobs.list_artifacts(spark, path).collect()}
    parts = {"features", "manifest", "preprocess", "rules", "signatures", "threshold"}
    assert listed == parts | {f"learners/{m}" for m in PAIR}
    assert spark.read.parquet(f"{version_folder(spark, path)}/rules").count() == run.detector.signatures.rule_count
    lines = dict(jobs.load_detector(spark, path).summary(spark).collect())
    assert lines["models"] == "2"


def test_failed_save_leaves_the_old_version(spark, run, tmp_path, monkeypatch):
    path = str(tmp_path / "detector")
    first = jobs.save_detector(run.detector, spark, path)

    def broken(*_):
        raise OSError("the disk is full")

    with monkeypatch.context() as patched:
        patched.setattr(jobs, "_write_json", broken)
        with pytest.raises(OSError):
            jobs.save_detector(run.detector, spark, path)
    assert versions(spark, path) == [first]
    assert jobs.load_detector(spark, path).threshold == run.detector.threshold

    other = jobs.Detector(run.detector.preprocess, run.detector.features, run.detector.learners, run.detector.ensemble, None, 0.25)
    second = jobs.save_detector(other, spark, path)
    assert [r[0] for r in jobs.list_versions(spark, path).collect()] == [first, second]
    assert jobs.stored_threshold(spark, path) == 0.25 and jobs.load_detector(spark, path).signatures is None
    assert jobs.load_detector(spark, path, first).signatures is not None and jobs.stored_threshold(spark, path, first) == run.detector.threshold
    assert "rules" not in {r[0] for r in jobs.list_artifacts(spark, path).collect()}
    with pytest.raises(FileNotFoundError):
        jobs.load_detector(spark, path, "000000099-none")
    with pytest.raises(FileNotFoundError):
        jobs.load_detector(spark, str(tmp_path / "nothing"))


def test_kernel_machine_stores_no_cosines(vectors, monkeypatch):
    """A kilobyte a row, and once more in each of the machines, is more disk than the input."""
    stored, keep = [], learners.cut_lineage
    monkeypatch.setattr(learners, "cut_lineage", lambda df, name="table": stored.append(df.columns) or keep(df, name))
    model = learners.fit_kernel_machine(vectors, "k", SHORT.kernel_machine, "label", "row_id")
    assert stored == [["label", "margin"]]
    right = learners.score_with({"k": model}, vectors).filter("pred_k = label").count()
    assert right > 0.9 * vectors.count()


def test_machines_in_shared_passes_equal_spark_s(vectors):
    width, gamma = learners.kernel_width(vectors)
    cosines = learners.RandomFourierFeatures(width, 48, gamma, 5, "k")
    n = vectors.count()
    mapped = cosines.transform(vectors).withColumn("fold", F.expr("if(row_id = 7, null, row_id % 3)")).cache()
    parts = [mapped.filter("fold <> 0"), mapped.filter("fold <> 2"), mapped]
    want = [
        LinearSVC(featuresCol="_k_cosines", labelCol="label", regParam=1 / n, maxIter=40, standardization=False).fit(p) for p in parts
    ]
    drawn = margins.Cosines(*cosines.projection())
    blocks = margins.feature_blocks(mapped, "features", "label", F.col("fold"), width)
    without = [0, 2, margins.EVERYTHING]
    got = margins.fit_machines(blocks, drawn, without, [1 / n] * 3, 40)

    def loss(weights, intercept, fold):
        rows = parts[without.index(fold)].count()
        return margins.hinge_sums(blocks, drawn, weights[:, None], np.array([intercept]), [fold])[0][0] / rows + weights @ weights / (2 * n)

    for fold, (weights, intercept), theirs in zip(without, got, want):
        assert loss(weights, intercept, fold) == pytest.approx(loss(theirs.coefficients.toArray(), theirs.intercept, fold), rel=1e-2)  # paths over corners part early
        assert loss(weights, intercept, fold) == pytest.approx(theirs.summary().objectiveHistory[-1], rel=1e-2)  # paths over corners part early
    outside = margins.margins_outside(vectors.sparkSession, blocks, drawn, [got[0], got[0], got[1]])
    assert outside.count() == n - 1  # a row without a fold is in no fold's training or test


@pytest.mark.parametrize("label, x", [("2", "0.0"), ("null", "0.0"), ("1", "double('inf')")])
def test_blocks_take_no_other_labels_or_infinite_features(spark, label, x):
    odd = spark.sql(f"SELECT array({x}, 1.0) AS a, int({label}) AS label").select("label", array_to_vector("a").alias("features"))
    with pytest.raises(Exception, match="label|finite"):
        margins.feature_blocks(odd, "features", "label", F.lit(0), 2).collect()


def test_kernel_machine_survives_saving(spark, parts, tmp_path):
    run = jobs.train_detector(parts[0], settings=SETTINGS, learners=("kernel_machine",))
    path = str(tmp_path / "kernel")
    jobs.save_detector(run.detector, spark, path)
    before = run.detector.score(parts[2]).orderBy("row_id").select("p_kernel_machine").collect()
    assert before == jobs.score_table(spark, path, parts[2]).orderBy("row_id").select("p_kernel_machine").collect()


def test_batch_report(run, traffic):
    scored = jobs.with_actual(run.detector.score(traffic), "label")
    report = jobs.batch_report(scored, "label")
    totals = dict(report["totals"].collect())
    assert sum(totals.values()) == 2000 and set(totals) <= {"Attack", "Normal"}
    assert report["metrics"].first()["accuracy"] > 0.9
    assert list(jobs.batch_report(scored)) == ["totals"]


def test_arriving_files_are_scored_once(spark, run, traffic, tmp_path):
    folder, output, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    write_table(traffic.filter("row_id < 500"), folder, "parquet")
    stream = arriving(spark, folder, traffic.schema)
    score_arriving(run.detector, stream, output, progress).awaitTermination()
    assert spark.read.parquet(output).count() == 500
    write_table(traffic.filter("row_id >= 500"), folder, "parquet", mode="append")
    score_arriving(run.detector, arriving(spark, folder, traffic.schema), output, progress).awaitTermination()
    got = spark.read.parquet(output).select("row_id", "prediction")
    want = run.detector.score(traffic).select("row_id", "prediction")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_pass_over_few_rows_is_one_task(spark, vectors):
    """A fit makes up to a thousand passes; each of them would start all the tasks that the table came in."""
    table = vectors.repartition(8).cache()
    table.count()
    tracker, group = spark.sparkContext.statusTracker(), "passes of a regression"
    spark.sparkContext.setJobGroup(group, group)
    try:
        learners.fit_logistic(table, "logistic_regression", LogisticSettings(max_iterations=20), "label", "row_id")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds]
    tasks = [tracker.getStageInfo(s).numTasks for s in stages]
    assert tasks.count(1) > 5 and tasks.count(8) <= 2  # the table is counted once


def test_tasks_of_a_pass_grow_with_the_rows(spark):
    table = spark.range(100, numPartitions=8)
    rows = learners.ROWS_PER_TASK
    found = [learners.few_tasks(table, n).rdd.getNumPartitions() for n in (0, rows, rows + 1, 5 * rows, 100 * rows)]
    assert found == [1, 1, 2, 5, 8]


def test_rows_of_few_files_are_dealt_to_all_cores(spark):
    """A written table of many rows may come back as one task, and a forest walks each row down all of its trees."""
    table, worth = spark.range(100, numPartitions=2), learners.FOREST_ROWS_PER_TASK
    found = [learners.more_tasks(table, n, worth).rdd.getNumPartitions() for n in (0, worth, 2 * worth, 2 * worth + 1, 100 * worth)]
    assert found == [2, 2, 2, 3, 4]  # the session has four cores
    assert learners.few_tasks(table, 3 * learners.ROWS_PER_TASK).rdd.getNumPartitions() == 3
    assert [on_all_cores(spark.range(9, numPartitions=n)).rdd.getNumPartitions() for n in (1, 4, 6)] == [4, 4, 6]


def test_a_forest_of_few_files_grows_on_all_cores(spark, vectors, monkeypatch):
    monkeypatch.setattr(learners, "FOREST_ROWS_PER_TASK", 300)
    dealt, keep = [], learners.with_class_weight
    monkeypatch.setattr(learners, "with_class_weight", lambda df, *a: dealt.append(df.rdd.getNumPartitions()) or keep(df, *a))
    learners.fit_random_forest(vectors.coalesce(1), "f", ForestSettings(trees=2, depth=2), "label", "row_id")
    assert dealt == [4]
