import math

import pytest
from pyspark.sql import functions as F

from palisade.config import FeatureSettings, PreprocessSettings
from palisade.operators import cleaning, encoding, features
from palisade.operators.preprocess import Preprocessor, PreprocessModel, gaps_left
from palisade.schema import categorical_columns, numeric_columns

SCHEMA = "row_id bigint, f1 double, f2 bigint, f3 string, f4 double, label int"
ROWS = [
    (0, 1.0, 10, "a", 0.1, 0),
    (1, 2.0, 20, "b", 0.1, 1),
    (2, None, 30, "a", 0.1, 0),
    (3, 4.0, 40, "b", 0.1, 1),
    (4, 5.0, 50, "a", 0.2, 0),
]


@pytest.fixture(scope="module")
def sample(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def repeated(spark):
    """The first two rows again, the first with another label."""
    return spark.createDataFrame([*ROWS, (5, 1.0, 10, "a", 0.1, 1), (6, 2.0, 20, "b", 0.1, 1)], SCHEMA).repartition(3)


def test_column_kinds(sample):
    assert numeric_columns(sample, exclude=("row_id", "label")) == ["f1", "f2", "f4"]
    assert categorical_columns(sample) == ["f3"]


@pytest.mark.parametrize("strategy, fill", [("mean", 3.0), ("median", 3.0), ("most_frequent", 1.0)])
def test_impute(sample, strategy, fill):
    fills = cleaning.fill_values(sample, ["f1"], ["f3"], strategy)
    out = cleaning.impute(sample, fills)
    assert gaps_left(out, ["f1", "f3"]).first()[0] == 0
    assert out.filter("row_id = 2").first()["f1"] == fill


def test_impute_errors(spark, sample):
    with pytest.raises(ValueError):
        cleaning.fill_values(sample, ["f1"], [], "drop")
    with pytest.raises(ValueError):
        cleaning.fill_values(spark.createDataFrame([(None,)], "x double"), ["x"], [], "mean")


def test_first_of_each_keeps_the_first_label_and_the_raw_cells(repeated):
    fills = {"f1": 3.0, "f2": 0.0, "f3": "a", "f4": 0.0}
    out = cleaning.first_of_each(repeated, ["f1", "f2", "f3", "f4"], "row_id", "label", fills)
    rows = {r["row_id"]: r for r in out.collect()}
    assert set(rows) == {0, 1, 2, 3, 4}
    assert rows[0]["label"] == 0 and rows[2]["f1"] is None
    assert dict(out.dtypes) == dict(repeated.dtypes)


def test_imputed_duplicates_are_duplicates(spark):
    df = spark.createDataFrame([(0, None, 1), (1, 2.0, 0), (2, 2.0, 1)], "row_id bigint, x double, label int")
    rows = cleaning.first_of_each(df, ["x"], "row_id", "label", {"x": 2.0}).collect()
    assert [tuple(r) for r in rows] == [(0, None, 1)]


def test_dedupe_is_a_hash_aggregation(repeated):
    out = cleaning.first_of_each(repeated, ["f1", "f2", "f3", "f4"], "row_id", "label", {"f1": 0.0})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Join" not in plan


def test_more_columns_than_mask_bits(spark):
    names = [f"c{i}" for i in range(70)]
    values = [None if i % 3 == 0 else float(i) for i in range(70)]
    df = spark.createDataFrame([(0, *values, 1)], "row_id bigint, " + ", ".join(f"{n} double" for n in names) + ", label int")
    out = cleaning.first_of_each(df, names, "row_id", "label", {n: -1.0 for n in names}).first()
    assert [out[n] for n in names] == values


def test_outliers(spark):
    df = spark.createDataFrame([(float(i), 7.0) for i in range(20)] + [(1000.0, 7.0), (None, 7.0)], "x double, k double")
    inside = cleaning.drop_outliers(df, cleaning.outlier_bounds(df, ["x", "k"], "iqr"))
    assert inside.count() == 21
    assert list(cleaning.outlier_bounds(df, ["x", "k"], "zscore")) == ["x"]
    assert cleaning.outlier_bounds(df, ["x"], None) == {}
    with pytest.raises(ValueError):
        cleaning.outlier_bounds(df, ["x"], "guess")


def test_one_hot_of_unseen_and_missing_is_all_zero(spark, sample):
    levels = encoding.categories(sample, ["f3"], 10)
    new = spark.createDataFrame([("a",), ("zzz",), (None,)], "f3 string")
    assert [tuple(r) for r in new.select(*encoding.indicators(levels)).collect()] == [(1.0, 0.0), (0.0, 0.0), (0.0, 0.0)]
    with pytest.raises(ValueError):
        encoding.categories(sample, ["f3"], 1)


def test_codes_survive_and_unseen_is_null(spark, sample):
    codes = encoding.code_table(sample, ["f3"])
    new = spark.createDataFrame([("b",), ("zzz",)], "f3 string")
    assert {tuple(r) for r in encoding.encode_with(new, codes, "f3", "code").collect()} == {("b", 1), ("zzz", None)}


def test_many_codes_are_numbered_without_one_sorted_task(spark):
    df = spark.range(500).select(
        F.concat(F.lit("user-"), F.col("id") * 7 % 501).alias("a"), (F.col("id") % 3).cast("string").alias("b")
    )
    got = {(r["column"], r["value"]): r["code"] for r in encoding.code_table(df, ["a", "b"], small=10).collect()}
    want = {}
    for c in ("a", "b"):
        for i, v in enumerate(sorted({r[c] for r in df.collect()})):
            want[c, v] = i
    assert got == want


@pytest.mark.parametrize("method", ["standard", "minmax", "robust"])
def test_constant_column_scales_to_zero(spark, method):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, 5.0)], "k double, x double")
    spans = encoding.scaling(df, ["k", "x"], method)
    out = df.select(*[encoding.scaled(c, *spans[c]) for c in ("k", "x")]).collect()
    assert [r["k"] for r in out] == [0.0, 0.0]
    with pytest.raises(ValueError):
        encoding.scaling(df, ["x"], "other")


def test_preprocess_trains_on_survivors_and_replays_every_row(repeated):
    model, rows = Preprocessor(PreprocessSettings()).fit_rows(repeated)
    assert rows.count() == 5
    trained = model.transform(rows)
    assert model.output_columns == ["f1", "f2", "f4", "f3_a", "f3_b"]
    assert {t for c, t in trained.dtypes if c in model.output_columns} == {"double"}
    assert model.transform(repeated).count() == 7
    assert model.training_rows(repeated).count() == 5
    stats = trained.agg(F.avg("f2"), F.stddev_pop("f2")).first()
    assert math.isclose(stats[0], 0.0, abs_tol=1e-12) and math.isclose(stats[1], 1.0)


def test_unfitted_and_incomplete_input(sample):
    with pytest.raises(ValueError):
        PreprocessModel().transform(sample)
    model = Preprocessor().fit(sample)
    with pytest.raises(ValueError, match="f2"):
        model.transform(sample.drop("f2"))


def test_outlier_filter_only_while_training(spark):
    rows = [(i, float(i), 0) for i in range(20)] + [(20, 1000.0, 1)]
    df = spark.createDataFrame(rows, "row_id bigint, x double, label int")
    model, kept = Preprocessor(PreprocessSettings(outliers="iqr")).fit_rows(df)
    assert kept.count() == 20 and model.transform(df).count() == 21


def test_booleans_become_numbers(spark):
    df = spark.createDataFrame([(0, True, 1), (1, False, 0)], "row_id bigint, b boolean, label int")
    model = Preprocessor(PreprocessSettings(scale=False)).fit(df)
    assert [r["b"] for r in model.transform(df).orderBy("row_id").collect()] == [1.0, 0.0]


@pytest.fixture(scope="module")
def table(spark):
    rows = []
    for i in range(100):
        y = i % 2
        rows.append((i, float((i * 37) % 101), y + (i % 7) / 10, (i * 53 % 97) * 1000.0, 1.0, 2.0 * ((i * 37) % 101), y))
    return spark.createDataFrame(
        rows, "row_id bigint, a double, good double, big double, flat double, twin double, label int"
    )


NAMES = ["a", "good", "big", "flat", "twin"]


@pytest.mark.parametrize("method", ["f_classif", "mutual_info"])
def test_importance_lists_every_column(table, method):
    rows = features.ranked_importance(table, NAMES, "label", method).collect()
    assert {r["feature"] for r in rows} == set(NAMES)
    assert rows[0]["feature"] == "good"
    assert dict(rows)["flat"] == pytest.approx(0.0, abs=1e-12)
    with pytest.raises(ValueError):
        features.ranked_importance(table, NAMES, "label", "magic")


def test_perfect_separator_scores_zero(spark):
    df = spark.createDataFrame([(0.0, 0), (0.0, 0), (1.0, 1), (1.0, 1)], "x double, label int")
    assert features.f_scores(df, ["x"], "label").first()["score"] == 0.0


def test_filters(table):
    assert features.varying_features(table, NAMES) == ["a", "good", "big", "twin"]
    assert features.uncorrelated_features(table, ["a", "good", "big", "twin"]) == ["a", "good", "big"]
    assert features.uncorrelated_features(table, ["twin"]) == ["twin"]
    with pytest.raises(ValueError):
        features.varying_features(table, ["flat"])


def test_later_column_wins_among_equal_scores(table):
    assert features.best_features(table, ["a", "twin"], "label", 1) == ["twin"]
    assert features.best_features(table, NAMES, "label", 99) == NAMES


def test_feature_stage(table):
    model = features.FeatureEngineer(FeatureSettings(k=3)).fit(table)
    assert len(model.output_columns) == 3
    assert model.transform(table).count() == 100
    full = features.FeatureEngineer(FeatureSettings(interactions=True, squares=True)).fit(table)
    assert "a_x_good" in full.output_columns and "big_pow_2" in full.output_columns
    # a column that is absent at inference is zero, an unknown one is passed by
    out = full.transform(table.drop("good").withColumn("extra", F.lit("x"))).first()
    assert out["good"] == 0.0 and out["extra"] == "x"
    with pytest.raises(ValueError):
        features.FeatureModel().transform(table)


def test_survivors_keep_large_whole_numbers(spark):
    rows = [(1, 9007199254740993, "a", 0), (2, 9007199254740993, "a", 1), (3, None, "b", 0)]
    df = spark.createDataFrame(rows, "row_id int, big bigint, name string, label int")
    fills = cleaning.fill_values(df, ["big"], ["name"], "mean")
    kept = {r["row_id"]: r["big"] for r in cleaning.first_of_each(df, ["big", "name"], "row_id", "label", fills).collect()}
    assert kept == {1: 9007199254740993, 3: None}
