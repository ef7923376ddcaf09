"""Voting over the score columns of several models, and what the signatures add to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.config import EnsembleSettings
from palisade.functions.cells import ratio
from palisade.functions.votes import (
    fused_label,
    fused_probability,
    hard_vote,
    mean_probability,
    normalised_weights,
    soft_vote,
)
from palisade.schema import quoted


def with_votes(df: DataFrame, models: list[str], settings: EnsembleSettings | None = None) -> DataFrame:
    """Add ``p_ensemble`` and ``vote`` from the ``p_<name>`` and ``pred_<name>`` columns.

    The mean probability is the same under hard voting; only the vote differs.
    """
    settings = settings or EnsembleSettings()
    if settings.voting not in ("soft", "hard"):
        raise ValueError(f"unknown voting {settings.voting!r}")
    weights = normalised_weights(len(models), settings.weights)
    p = [F.col(quoted(f"p_{m}")) for m in models]
    if settings.voting == "hard":
        vote = hard_vote([F.col(quoted(f"pred_{m}")) for m in models], weights)
    else:
        vote = soft_vote(p, weights)
    return df.withColumns({"p_ensemble": mean_probability(p, weights), "vote": vote})


def with_fusion(df: DataFrame, hit: str, p: str, threshold: float) -> DataFrame:
    """Add ``p_attack`` and ``prediction`` after the signatures had their say."""
    return df.withColumns(
        {
            "p_attack": fused_probability(F.col(quoted(hit)), F.col(quoted(p))),
            "prediction": fused_label(F.col(quoted(hit)), F.col(quoted(p)), threshold),
        }
    )


def model_outputs(df: DataFrame, row_id: str, models: list[str], prefix: str) -> DataFrame:
    """(row_id, model, value): one row per row and model, from the ``<prefix><name>`` columns."""
    named = df.select(F.col(quoted(row_id)), *[F.col(quoted(f"{prefix}{m}")).alias(m) for m in models])
    return named.unpivot([row_id], models, "model", "value")


def fusion_report(df: DataFrame, hit: str, p: str, threshold: float, y: str | None = None) -> DataFrame:
    """One row: how many records the signatures and the ensemble flag.

    With labels also the share of actual attacks that a signature hits, and the accuracy.
    """
    sig = F.col(quoted(hit)) == 1
    label = fused_label(F.col(quoted(hit)), F.col(quoted(p)), threshold)
    n = F.count(F.lit(1))
    parts: list[Column] = [
        n.alias("n_records"),
        F.count_if(sig).alias("n_signature_hits"),
        ratio(F.count_if(sig), n).alias("signature_hit_rate"),
        F.count_if(label == 1).alias("n_flagged"),
        F.count_if(~sig & (label == 1)).alias("n_flagged_by_ensemble_only"),
        F.lit(float(threshold)).alias("threshold"),
    ]
    if y is not None:
        actual = F.col(quoted(y))
        parts += [
            ratio(F.count_if(sig & (actual == 1)), F.count_if(actual == 1)).alias("attacks_hit_by_signatures"),
            ratio(F.count_if(label == actual), n).alias("accuracy"),
        ]
    return df.agg(*parts)


def ensemble_summary(
    spark: SparkSession, models: list[str], settings: EnsembleSettings, threshold: float, signatures: int | None
) -> DataFrame:
    """(key, value) lines that describe a detector."""
    weights = normalised_weights(len(models), settings.weights)
    lines = [
        ("detector", "ensemble" if signatures is None else "signatures + ensemble"),
        ("threshold", f"{threshold:.3f}"),
        ("voting", settings.voting),
        ("models", str(len(models))),
        *[(f"weight of {m}", f"{w:.3f}") for m, w in zip(models, weights)],
    ]
    if signatures is not None:
        lines.append(("signatures", str(signatures)))
    return spark.createDataFrame(lines, "key string, value string")


def rule_report(model, df: DataFrame, probability: str, threshold: float, y: str) -> DataFrame:
    """(rank, n_hits, n_attacks, n_only_this_rule, n_beyond_ensemble) per rule of a signature model.

    What a rule adds to the fusion: the rows it hits, the attacks among them, the rows that no other
    rule hits, and the rows that the ensemble alone would have passed.  One pass over the table.
    """
    hits = model.matches(df)
    if not hits:
        return df.sparkSession.createDataFrame([], "rank int, n_hits bigint, n_attacks bigint, n_only_this_rule bigint, n_beyond_ensemble bigint")
    marked = df.select(F.array(*hits).alias("hit"), F.col(quoted(y)).alias("y"), F.col(quoted(probability)).alias("p"))
    each = marked.select(
        "y", "p", F.aggregate("hit", F.lit(0), lambda a, b: a + b).alias("k"), F.posexplode("hit").alias("at", "is_hit")
    ).filter("is_hit = 1")
    # Rules without a row left are kept: every rule is counted from a list of all ranks.
    found = each.groupBy("at").agg(
        F.count(F.lit(1)).alias("n_hits"),
        F.count_if(F.col("y") == 1).alias("n_attacks"),
        F.count_if(F.col("k") == 1).alias("n_only_this_rule"),
        F.count_if(~F.coalesce(F.col("p") >= threshold, F.lit(False))).alias("n_beyond_ensemble"),
    )
    ranks = df.sparkSession.range(len(hits)).select(F.col("id").cast("int").alias("place"))
    names = ["n_hits", "n_attacks", "n_only_this_rule", "n_beyond_ensemble"]
    return ranks.join(found, F.col("place") == F.col("at"), "left").select(
        (F.col("place") + 1).alias("rank"), *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in names]
    )
