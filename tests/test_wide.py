import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from palisade.operators import correlation, encoding, features
from palisade.operators.correlation import correlated_columns, correlated_entries
from palisade.operators.signatures import rule_matches, with_rule_hits
from palisade.operators.sparse import SparseOneHot, SparseOneHotModel, category_dictionary


@pytest.fixture(scope="module")
def shop(spark):
    """2,100 categories in three columns, with missing ones."""
    part = F.concat(F.lit("p"), (F.col("id") * 7 % 2000).cast("string"))
    town = F.when(F.col("id") % 50 != 0, F.concat(F.lit("t"), (F.col("id") % 97).cast("string")))
    return spark.range(12_000).select(
        F.col("id").alias("row_id"), part.alias("part"), town.alias("town"), F.lit("all").alias("one"),
        (F.col("id") % 3).cast("double").alias("x"), F.when(F.col("id") * 7 % 2000 < 600, 1).otherwise(0).alias("label"),
    ).cache()


def test_dictionary_is_sorted_and_dense(shop):
    rows = sorted(category_dictionary(shop, ["part", "town", "one"]).collect(), key=lambda r: r["index"])
    assert [r["index"] for r in rows] == list(range(2098))
    assert [(r["place"], r["value"]) for r in rows] == sorted((r["place"], r["value"]) for r in rows)
    assert {r["column"] for r in rows[:2000]} == {"part"} and rows[-1]["column"] == "one"


def test_sparse_rows_equal_the_named_form(shop):
    columns = ["part", "town", "one"]
    model = SparseOneHot(columns, ["x"]).fit(shop)
    some = shop.filter("row_id < 60").withColumn("part", F.when(F.col("row_id") == 5, "unseen").otherwise(F.col("part")))
    got = {r["row_id"]: r["features"] for r in model.transform(some).collect()}
    levels = encoding.categories(shop, columns)
    names = [(c, v) for c in columns for v in levels[c]]
    assert model.size == 1 + len(names)
    for r in some.collect():
        want = [r["x"], *[1.0 if r[c] == v else 0.0 for c, v in names]]
        assert got[r["row_id"]].size == model.size and got[r["row_id"]].toArray().tolist() == want


def test_vectors_train_a_model(shop):
    model = SparseOneHot(["part", "town"]).fit(shop)
    prepared = model.transform(shop)
    fitted = LogisticRegression(maxIter=15, regParam=0.001).fit(prepared)
    assert fitted.transform(prepared).filter("prediction <> label").count() == 0


def test_reloaded_dictionary(shop, tmp_path):
    model = SparseOneHot(["town"], path=str(tmp_path / "dictionary")).fit(shop)
    model.write().overwrite().save(str(tmp_path / "model"))
    again = SparseOneHotModel.load(str(tmp_path / "model"))
    assert again.size == 97 and again.transform(shop).exceptAll(model.transform(shop)).isEmpty()


def test_encoding_expressions_do_not_grow_with_categories(shop):
    model = SparseOneHot(["part", "town"]).fit(shop)
    assert len(model.entries(shop)._jdf.queryExecution().optimizedPlan().toString()) < 10_000


def test_no_rows_and_no_categories(spark):
    empty = spark.createDataFrame([], "row_id bigint, c string")
    model = SparseOneHot(["c"]).fit(empty)
    assert model.size == 0 and model.entries(empty).count() == 0
    missing = spark.createDataFrame([(1, None)], "row_id bigint, c string")
    assert SparseOneHot(["c"]).fit(missing).entries(missing).first()["entries"] == []


def strong(matrix, limit):
    r = np.corrcoef(matrix, rowvar=False)
    return {(i, j): r[i, j] for j in range(r.shape[1]) for i in range(j) if abs(r[i, j]) > limit}


def mixed(n, p, seed):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, p)) * draw.uniform(0.1, 50, p) + draw.uniform(-1e6, 1e6, p)
    for j in range(3, p, 7):
        x[:, j] = 3 * x[:, j - 3] - 5 + 0.01 * draw.normal(size=n)
    x[:, p // 2] = -x[:, 0]
    x[:, 1] = 4.0
    return x


@pytest.mark.parametrize(("tile", "block", "rows", "parts"), [(1024, 128, 2048, 3), (10, 4, 7, 5), (7, 7, 1000, 1)])
def test_blocks_equal_one_matrix(spark, monkeypatch, tile, block, rows, parts):
    for name, value in (("TILE", tile), ("BLOCK", block), ("ROWS", rows)):
        monkeypatch.setattr(correlation, name, value)
    x = mixed(200, 31, 3)
    names = [f"c.{j}" for j in range(31)]
    df = spark.createDataFrame(x.tolist(), names).repartition(parts)
    with np.errstate(invalid="ignore", divide="ignore"):
        want = strong(x, 0.5)
    got = {(r["first"], r["second"]): r["r"] for r in correlated_columns(df, names, 0.5).collect()}
    assert got.keys() == want.keys() and len(got) > 4
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in got)


def test_large_means_cost_no_precision(spark):
    draw = np.random.default_rng(1)
    a = draw.normal(size=500)
    x = np.column_stack([a + 1e9, a + 0.1 * draw.normal(size=500) - 1e9])
    df = spark.createDataFrame(x.tolist(), ["a", "b"]).repartition(6)
    assert correlated_columns(df, ["a", "b"], 0.0).first()["r"] == pytest.approx(np.corrcoef(x.T)[0, 1], abs=1e-6)


def test_sparse_blocks_equal_one_matrix(spark, monkeypatch):
    monkeypatch.setattr(correlation, "TILE", 9)
    monkeypatch.setattr(correlation, "BLOCK", 4)
    draw = np.random.default_rng(5)
    x = (draw.random((300, 23)) < 0.2) * draw.integers(1, 4, (300, 23)).astype(float)
    x[:, 20] = x[:, 2]
    x[:, 7] = 0
    rows = [(i, [(int(j), float(v[j])) for j in np.flatnonzero(v)]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, entries array<struct<index:int,value:double>>")
    with np.errstate(invalid="ignore", divide="ignore"):
        want = strong(x, 0.1)
    got = {(r["first"], r["second"]): r["r"] for r in correlated_entries(df, 23, "entries", 0.1).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in got)


def test_entries_of_very_many_columns(spark):
    """The work grows with the entries: 200,000 columns, pairs that share no row, a column that is large and one that is constant."""
    draw = np.random.default_rng(9)
    n, width = 3_000, 200_000
    x = np.column_stack([draw.normal(size=n) + 1e6, np.full(n, 0.1), draw.integers(0, 4, n), draw.integers(0, 2, n)])
    cells = [
        [(0, float(a)), (1, float(b)), (10 + int(c) * 40_000, 1.0), (180_000 + int(d), 1.0), (190_000 + i % 1_500, float(a) - 1e6)]
        for i, (a, b, c, d) in enumerate(x.tolist())
    ]
    dense = np.zeros((n, 8 + 1_500))
    place = [0, 1, *[10 + c * 40_000 for c in range(4)], 180_000, 180_001, *range(190_000, 191_500)]
    at = {k: j for j, k in enumerate(place)}
    for i, row in enumerate(cells):
        for k, value in row:
            dense[i, at[k]] = value
    dense[:, 1] = 0  # of no correlation
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "id int, entries array<struct<index:int,value:double>>")
    with np.errstate(invalid="ignore", divide="ignore"):
        want = {(place[i], place[j]): r for (i, j), r in strong(dense, 0.1).items()}
    assert (10, 40_010) in want and (180_000, 180_001) in want
    got = {(r["first"], r["second"]): r["r"] for r in correlated_entries(df, width, "entries", 0.1).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in got)


def test_no_entries_have_no_correlation(spark):
    nothing = spark.createDataFrame([], "entries array<struct<index:int,value:double>>")
    assert correlated_entries(nothing, 0, "entries", 0.1).count() == 0


def test_no_rows_have_no_correlation(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert correlated_columns(df, ["a", "b"], 0.1).count() == 0
    assert features.uncorrelated_features(spark.createDataFrame([(1.0, 2.0)], "a double, b double"), ["a", "b"]) == ["a", "b"]


RULES = [(1, ["a"], ["x"]), (2, ["a", "b"], ["y", "1"]), (3, ["land"], ["1"]), (4, ["gone"], ["x"]), (5, ["a"], ["x"]), (6, ["b", "a"], ["2", "z"])]


def test_rules_of_a_table(spark):
    rules = spark.createDataFrame(RULES, "rank int, columns array<string>, values array<string>")
    rows = [(0, "x", 5, 0.0), (1, "y", 1, 0.0), (2, "y", 2, 0.0), (3, None, 1, 1.0), (4, "z", 2, None), (5, "q", None, 0.0), (6, "x", 1, 1.0)]
    df = spark.createDataFrame(rows, "row_id int, a string, b int, land double")
    assert {r["row_id"]: r["sig"] for r in with_rule_hits(df, rules).collect()} == {0: 1, 1: 1, 2: 0, 3: 1, 4: 1, 5: 0, 6: 1}
    found = sorted(tuple(r) for r in rule_matches(df, rules, "row_id").collect())
    assert found == [(0, 1), (0, 5), (1, 2), (3, 3), (4, 6), (6, 1), (6, 3), (6, 5)]
    none = with_rule_hits(df, rules.limit(0))
    assert none.columns == [*df.columns, "sig"] and none.agg(F.sum("sig")).first()[0] == 0
    assert rule_matches(df, rules.limit(0), "row_id").count() == 0


def test_a_hundred_thousand_rules(spark):
    rules = spark.range(100_000).select(F.col("id").alias("rank"), F.array(F.lit("part")).alias("columns"), F.array((F.col("id") * 2).cast("string")).alias("values"))
    df = spark.range(0, 300_000, 3).select(F.col("id").alias("row_id"), F.col("id").alias("part"))
    hits = with_rule_hits(df, rules)
    assert hits.agg(F.sum("sig")).first()[0] == 33_334
    assert len(hits._jdf.queryExecution().optimizedPlan().toString()) < 5_000
