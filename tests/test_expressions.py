import math

import pytest
from pyspark.sql import functions as F

from palisade.config import EnsembleSettings
from palisade.functions import cells, votes
from palisade.operators import ensemble


def test_binary_label_counts_missing_as_attack(spark):
    df = spark.createDataFrame([("normal",), ("smurf",), (None,)], "label string")
    assert [r[0] for r in cells.with_binary_label(df).collect()] == [0, 1, 1]


def test_finite_or_zero(spark):
    df = spark.createDataFrame([(1.5,), (None,), (math.nan,), (math.inf,), (-math.inf,)], "x double")
    assert [r[0] for r in df.select(cells.finite_or_zero(F.col("x"))).collect()] == [1.5, 0, 0, 0, 0]


def test_align_adds_drops_and_orders(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "id int, a double, b double")
    out = cells.align(df, ["b", "new"], keep=("id",))
    assert out.columns == ["id", "b", "new"] and out.first() == (1, 3.0, 0.0)


def test_boundary_rules(spark):
    df = spark.createDataFrame([(0.5,)], "p double")
    p = [F.col("p"), F.col("p")]
    row = df.select(cells.decide(F.col("p"), 0.5), votes.soft_vote(p, [0.5, 0.5])).first()
    assert tuple(row) == (1, 0)  # a threshold counts its boundary, a vote gives a draw to class 0


def test_hard_vote_draw_is_normal(spark):
    df = spark.createDataFrame([(0, 1), (1, 1), (1, 0)], "a int, b int")
    vote = votes.hard_vote([F.col("a"), F.col("b")], [0.5, 0.5])
    assert [r[0] for r in df.select(vote).collect()] == [0, 1, 0]
    weighted = votes.hard_vote([F.col("a"), F.col("b")], [0.6, 0.4])
    assert [r[0] for r in df.select(weighted).collect()] == [0, 1, 1]


def test_signature_hit_wins_at_any_threshold(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.98), (0, 1.0)], "sig int, p double")
    out = ensemble.with_fusion(df, "sig", "p", 0.995).collect()
    assert [r["prediction"] for r in out] == [1, 0, 1]
    assert [r["p_attack"] for r in out] == [0.99, 0.98, 1.0]


def test_weights():
    assert votes.normalised_weights(4) == [0.25] * 4
    assert math.isclose(sum(votes.normalised_weights(2, [0.6, 0.4])), 1.0)
    assert votes.normalised_weights(2, [3, 1]) == [0.75, 0.25]
    with pytest.raises(ValueError):
        votes.normalised_weights(2, [1.0])
    with pytest.raises(ValueError):
        votes.normalised_weights(0)


def test_voting_columns_and_summary(spark):
    df = spark.createDataFrame([(0.9, 1, 0.2, 0), (0.1, 0, 0.3, 0)], "p_a double, pred_a int, p_b double, pred_b int")
    for voting in ("soft", "hard"):
        out = ensemble.with_votes(df, ["a", "b"], EnsembleSettings(voting, (0.6, 0.4))).collect()
        assert {r["vote"] for r in out} <= {0, 1}
        assert math.isclose(out[0]["p_ensemble"], 0.62)
    with pytest.raises(ValueError):
        ensemble.with_votes(df, ["a", "b"], EnsembleSettings("loud"))
    lines = dict(ensemble.ensemble_summary(spark, ["a", "b"], EnsembleSettings(), 0.5, 3).collect())
    assert lines["voting"] == "soft" and lines["models"] == "2" and lines["signatures"] == "3"


def test_fusion_report_of_empty_table(spark):
    empty = spark.createDataFrame([], "sig int, p double, y int")
    row = ensemble.fusion_report(empty, "sig", "p", 0.5, "y").first().asDict()
    assert row["n_records"] == 0 and row["signature_hit_rate"] == 0.0 and row["attacks_hit_by_signatures"] == 0.0
