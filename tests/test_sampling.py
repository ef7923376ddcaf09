import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from palisade.functions.draws import portable_draw
from palisade.operators import sampling
from palisade.operators.multiclass import LabelCodes


@pytest.fixture(scope="module")
def skewed(spark):
    """One class holds nine tenths of the rows."""
    kind = F.when(F.col("id") % 100 < 90, "big").when(F.col("id") % 100 < 99, "mid").otherwise("tiny")
    return spark.range(3000).select(F.col("id").alias("row_id"), kind.alias("label"), (F.col("id") * 2).alias("x")).cache()


def counts(df):
    return dict(Counter(r["label"] for r in df.select("label").collect()))


def ids(df):
    return sorted(r["row_id"] for r in df.select("row_id").collect())


def test_stratified_sizes_are_exact(skewed):
    train, holdout = sampling.holdout_split(skewed, row_id="row_id", label="label")
    assert counts(holdout) == {"big": 540, "mid": 54, "tiny": 6}
    assert sorted(ids(train) + ids(holdout)) == list(range(3000))
    assert train.columns == skewed.columns


def test_split_depends_on_rows_and_seed_only(skewed):
    first = ids(sampling.holdout_split(skewed, row_id="row_id", label="label")[1])
    again = ids(sampling.holdout_split(skewed.repartition(7, "x"), row_id="row_id", label="label")[1])
    other = ids(sampling.holdout_split(skewed, row_id="row_id", label="label", seed=1)[1])
    assert first == again != other


def test_split_does_not_shuffle_whole_rows(skewed):
    train, _ = sampling.holdout_split(skewed, row_id="row_id", label="label")
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("n, fraction", [(10, 0.2), (11, 0.2), (7, 0.5), (1, 0.2), (3, 0.0)])
def test_plain_split(spark, n, fraction):
    df = spark.range(n).withColumnRenamed("id", "row_id")
    train, holdout = sampling.holdout_split(df, row_id="row_id", label=None, fraction=fraction)
    assert holdout.count() == math.ceil(fraction * n) and train.count() == n - math.ceil(fraction * n)


def train_sizes(counts, holdout):
    """Largest remainders, ties to the smaller class, none last."""
    total = sum(counts.values())
    train = total - math.ceil(holdout * total - 1e-9)
    sizes = {c: n * train // total for c, n in counts.items()}
    order = sorted(counts, key=lambda c: (-(counts[c] * train % total), c is None, c if c is not None else 0))
    for c in order[: train - sum(sizes.values())]:
        sizes[c] += 1
    return sizes


@pytest.mark.parametrize("sizes", [{0: 5, 1: 3, 2: 2}, {0: 1, 1: 1, 2: 1}, {"a": 333, "b": 334, None: 333}, {None: 1, 1: 1}, {3: 7}, dict.fromkeys(range(500), 3)])
def test_train_sizes_add_up(spark, sizes):
    kind = "string" if "a" in sizes else "int"
    classes = spark.createDataFrame(list(sizes.items()), f"_class {kind}, n bigint")
    for holdout in (0.2, 0.5, 0.0, 1.0):
        train = {r["_class"]: r["train"] for r in sampling.with_train_sizes(classes, holdout).collect()}
        assert sum(train.values()) == sum(sizes.values()) - math.ceil(holdout * sum(sizes.values()))
        assert train == train_sizes(sizes, holdout)


def test_classes_as_many_as_rows(spark):
    df = spark.range(5000).select(F.col("id").alias("row_id"), (F.col("id") % 2500).alias("label"))
    marked = sampling.three_way_parts(df, row_id="row_id", label="label")
    assert dict(marked.groupBy("part").count().collect()) == {0: 3200, 1: 800, 2: 1000}


def test_split_of_no_rows(spark):
    df = spark.createDataFrame([], "row_id bigint, label string")
    assert [p.count() for p in sampling.three_way_split(df, row_id="row_id", label="label")] == [0, 0, 0]
    assert sampling.undersample(df, row_id="row_id", label="label").count() == 0
    assert sampling.oversample(df, row_id="row_id", label="label").count() == 0


def test_three_parts_lose_no_row(skewed):
    parts = sampling.three_way_split(skewed, row_id="row_id", label="label")
    assert sorted(i for p in parts for i in ids(p)) == list(range(3000))
    assert [p.count() for p in parts] == [1920, 480, 600]
    assert all(set(counts(p)) == {"big", "mid", "tiny"} for p in parts)


def test_missing_labels_form_a_stratum(spark):
    df = spark.createDataFrame([(i, None if i < 10 else 1) for i in range(30)], "row_id bigint, label int")
    _, holdout = sampling.holdout_split(df, row_id="row_id", label="label")
    assert counts(holdout) == {None: 2, 1: 4}


def test_undersample(skewed):
    out = sampling.undersample(skewed, row_id="row_id", label="label")
    assert counts(out) == {"big": 30, "mid": 30, "tiny": 30}
    assert len(set(ids(out))) == 90


def test_oversample_told_as_times_is_the_same_bootstrap(skewed):
    copies = Counter(map(tuple, sampling.oversample(skewed, row_id="row_id", label="label").collect()))
    told = sampling.oversample(skewed, row_id="row_id", label="label", times="times").collect()
    assert {tuple(r)[:-1]: r["times"] for r in told} == copies and len(told) == len(copies)


@pytest.mark.parametrize("rows_per_cell", [4096, 50, 1])
def test_oversample(skewed, monkeypatch, rows_per_cell):
    """One level of the tree, and several."""
    monkeypatch.setattr(sampling, "ROWS_PER_CELL", rows_per_cell)
    monkeypatch.setattr(sampling, "TREE_BITS", 3)
    out = sampling.oversample(skewed, row_id="row_id", label="label").cache()
    assert counts(out) == {"big": 2700, "mid": 2700, "tiny": 2700}
    own = {r["row_id"]: tuple(r) for r in skewed.collect()}
    assert all(own[r["row_id"]] == tuple(r) for r in out.collect())
    picked = Counter(r["row_id"] for r in out.filter("label = 'tiny'").collect())
    assert len(picked) > 25 and max(picked.values()) < 200  # about 90 copies of each of the 30 rows
    assert len(set(ids(out.filter("label = 'big'")))) == 2700


def test_bootstrap_depends_on_rows_and_seed_only(skewed):
    def rows(df, seed=42):
        return Counter(r["row_id"] for r in sampling.oversample(df, row_id="row_id", label="label", seed=seed).collect())

    assert rows(skewed) == rows(skewed.repartition(9, "x")) != rows(skewed, 1)


def test_bootstrap_picks_are_independent(spark, monkeypatch):
    """Times that a row is picked have the mean and variance of a multinomial draw."""
    monkeypatch.setattr(sampling, "ROWS_PER_CELL", 16)
    df = spark.range(5000).select(F.col("id").alias("row_id"), F.when(F.col("id") < 1000, "few").otherwise("many").alias("label"))
    out = sampling.oversample(df, row_id="row_id", label="label").filter("label = 'few'")
    times = [r["n"] for r in df.filter("label = 'few'").join(out.groupBy("row_id").agg(F.count("*").alias("n")), "row_id", "left").fillna(0).collect()]
    mean = sum(times) / 1000
    assert mean == 4.0 and 3.3 < sum((t - mean) ** 2 for t in times) / 1000 < 4.8


def test_balance_strategies(skewed):
    assert sampling.balance(skewed, row_id="row_id", label="label", strategy="undersample").count() == 90
    with pytest.raises(ValueError):
        sampling.balance(skewed, row_id="row_id", label="label", strategy="guess")


def test_class_weights(skewed):
    weights = dict(sampling.class_weights(skewed, "label").collect())
    assert weights == pytest.approx({"big": 3000 / 8100, "mid": 3000 / 810, "tiny": 3000 / 90})
    assert set(dict(sampling.class_weights(skewed, "label", "uniform").collect()).values()) == {1.0}
    rows = sampling.with_class_weight(skewed, "label")
    assert rows.agg(F.sum("weight")).first()[0] == pytest.approx(3000)
    with pytest.raises(ValueError):
        sampling.class_weights(skewed, "label", "guess")


def test_label_codes(spark, skewed):
    codes = LabelCodes("label").fit(skewed)
    assert dict(codes.mapping.collect()) == {"big": 0, "mid": 1, "tiny": 2}
    encoded = codes.encode(skewed, "y")
    back = codes.decode(encoded.drop("label"), "y", "label")
    assert counts(back) == counts(skewed) and encoded.count() == 3000
    with pytest.raises(ValueError):
        LabelCodes("label").decode(skewed, "row_id", "name")


def test_weights_of_very_many_classes_and_of_no_class(spark):
    rows = [(i, f"c{i % 12_000}") for i in range(24_001)] + [(30_000, None)]
    df = spark.createDataFrame(rows, "row_id int, label string")
    table = {r["class"]: r["weight"] for r in sampling.class_weights(df, "label").collect()}
    weighted = sampling.with_class_weight(df, "label").collect()
    assert len(table) == 12_000 and len(weighted) == len(rows)
    assert all(r["weight"] == table.get(r["label"]) for r in weighted)


def test_cuts_compute_each_draw_once(spark, monkeypatch):
    found = {}

    def settled(df, name):
        found[name] = df
        return spark.createDataFrame(df.collect(), df.schema)

    monkeypatch.setattr(sampling, "_settled", settled)
    rows = spark.range(20_000).select(F.col("id").alias("row_id"), (F.col("id") % 3).alias("label"))
    sampling.holdout_parts(rows, row_id="row_id", label="label", draw=portable_draw(42, F.col("row_id")))
    assert found["cuts"]._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1


def test_class_weights_leave_rows_in_their_tasks(spark):
    """Joined by shuffling, two classes are two tasks, however many rows and cores there are."""
    rows = spark.range(4000, numPartitions=4).select("id", (F.col("id") % 2).alias("label"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        weighted = sampling.with_class_weight(rows, "label")
        assert weighted.rdd.glom().map(len).collect() == [1000] * 4
        assert {r[0] for r in weighted.select("weight").distinct().collect()} == {1.0}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
