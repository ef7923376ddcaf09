"""Signatures, voting, fusion, evaluation, learners and whole jobs."""

from __future__ import annotations

from functools import cached_property

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.config import DetectorSettings, EnsembleSettings, FusionSettings, SignatureSettings
from palisade.functions import cells, votes
from palisade.operators import ensemble, evaluate, features, learners, sampling
from palisade.operators.multiclass import LabelCodes
from palisade.operators.signatures import (
    SignatureMiner,
    candidate_rules,
    mine_signatures,
    rule_text,
)
from palisade.plans import detector as jobs
from palisade.plans import views
from palisade.plans.queries.preparing import labelled, rounded
from palisade.plans.queries.registry import WITH_BIN, WITH_CONN, WITH_DOCS, WITH_SCORES, query
from palisade.session import cut_lineage, on_all_cores, scratch_path
from palisade.sources import runs
from palisade.streaming.scoring import arriving, score_arriving

# --- signatures ----------------------------------------------------------------


def _candidates_sql(table: str, label: str, categorical: list[str], flags: list[str]) -> str:
    """(gen, first, second, n, attacks) in generation order: singles, flags, pairs."""
    parts, gen = [], 0
    for c in categorical:
        parts.append(
            f"SELECT {gen} AS gen, CAST({c} AS VARCHAR) AS first, CAST(NULL AS VARCHAR) AS second, count(*) AS n, "
            f"sum({label}) AS attacks, '{c}' AS a, CAST(NULL AS VARCHAR) AS b FROM {table} WHERE {c} IS NOT NULL GROUP BY {c}"
        )
        gen += 1
    for c in flags:
        parts.append(
            f"SELECT {gen}, '1', NULL, count(*), sum({label}), '{c}', NULL FROM {table} WHERE {c} = 1 HAVING count(*) > 0"
        )
        gen += 1
    for i, a in enumerate(categorical):
        for b in categorical[i + 1 :]:
            parts.append(
                f"SELECT {gen}, CAST({a} AS VARCHAR), CAST({b} AS VARCHAR), count(*), sum({label}), '{a}', '{b}' FROM {table} "
                f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY {a}, {b}"
            )
            gen += 1
    return " UNION ALL ".join(parts)


def _rules_ctes(table: str, label: str, categorical: list[str], flags: list[str], s: SignatureSettings) -> str:
    return f"""candidates AS ({_candidates_sql(table, label, categorical, flags)}),
    passing AS (SELECT *, CAST(n AS DOUBLE) / (SELECT count(*) FROM {table}) AS support,
        CAST(attacks AS DOUBLE) / n AS confidence FROM candidates),
    ordered AS (SELECT *, row_number() OVER (ORDER BY confidence DESC, support DESC, gen, first, second NULLS FIRST) AS place
        FROM passing WHERE support >= CAST({s.min_support} AS DOUBLE) AND confidence >= CAST({s.min_confidence} AS DOUBLE)),
    rules AS (SELECT CAST(row_number() OVER (ORDER BY place) AS INT) AS rank, *,
        CASE WHEN b IS NULL THEN a || '=' || first ELSE a || '=' || first || ' AND ' || b || '=' || second END AS rule
      FROM ordered p WHERE NOT EXISTS (SELECT 1 FROM ordered s WHERE s.place < p.place AND s.b IS NULL AND p.b IS NOT NULL
        AND ((s.a = p.a AND s.first = p.first) OR (s.a = p.b AND s.first = p.second)))
      ORDER BY place LIMIT {s.max_rules})"""


_CATEGORICAL = ["protocol_type", "service", "flag"]
_DEFAULT = SignatureSettings()
_LOOSE = SignatureSettings(min_support=0.0005, min_confidence=0.3, max_rules=12)
_RULE_COLUMNS = "rank, rule, support, confidence, n AS match_count"


@query(
    "signature_candidates",
    f"""{WITH_BIN} SELECT gen, first, second, n, CAST(attacks AS BIGINT) AS attacks
    FROM ({_candidates_sql('bin', 'label', _CATEGORICAL, ['land'])})""",
)
def signature_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidate_rules(labelled(spark, sf_dir), "label", _DEFAULT)


def _rules_query(name: str, s: SignatureSettings) -> None:
    sql = f"{WITH_BIN}, {_rules_ctes('bin', 'label', _CATEGORICAL, ['land'], s)} SELECT {_RULE_COLUMNS} FROM rules"

    @query(name, sql)
    def rules(spark, sf_dir):
        mined = mine_signatures(labelled(spark, sf_dir), "label", s)
        return mined.select("rank", "rule", "support", "confidence", "match_count")


_rules_query("signature_rules", _DEFAULT)
_rules_query("signature_rules_capped", _LOOSE)
_rules_query("signature_rules_pruned", SignatureSettings(min_support=0.01, min_confidence=0.5, prune_rare=True))
_DOC_RULES = SignatureSettings(("lang", "source"), ("quality",), min_support=0.01, min_confidence=0.02)


@query(
    "document_signature_rules",
    f"""{WITH_DOCS}, {_rules_ctes('docs', 'toxic', ['lang', 'source'], ['quality'], _DOC_RULES)}
    SELECT {_RULE_COLUMNS} FROM rules""",
)
def document_signature_rules(spark, sf_dir):
    mined = mine_signatures(views.labelled_documents(spark, sf_dir), "toxic", _DOC_RULES)
    return mined.select("rank", "rule", "support", "confidence", "match_count")


@query(
    "signature_texts",
    f"""{WITH_BIN}, {_rules_ctes('bin', 'label', _CATEGORICAL, ['land'], _DEFAULT)}
    SELECT rank, 'IF ' || CASE WHEN a = 'land' THEN 'land=1' WHEN b IS NULL THEN a || '=''' || first || chr(39)
      ELSE a || '=''' || first || ''' AND ' || b || '=''' || second || chr(39) END || ' THEN Attack (support=' || printf('%.4f', support) || ', confidence='
      || printf('%.4f', confidence) || ', n=' || n || ')' AS text FROM rules""",
)
def signature_texts(spark, sf_dir):
    return rule_text(mine_signatures(labelled(spark, sf_dir), "label", _DEFAULT))


_MATCHES = " OR ".join(
    f"(r.a = '{c}' AND r.first = CAST(x.{c} AS VARCHAR) AND r.b IS NULL)" for c in [*_CATEGORICAL, "land"]
) + " OR " + " OR ".join(
    f"(r.a = '{a}' AND r.b = '{b}' AND r.first = x.{a} AND r.second = x.{b})"
    for i, a in enumerate(_CATEGORICAL)
    for b in _CATEGORICAL[i + 1 :]
)


@query(
    "signature_hits",
    f"""{WITH_BIN}, {_rules_ctes('bin', 'label', _CATEGORICAL, ['land'], _DEFAULT)}
    SELECT row_id, CAST(EXISTS (SELECT 1 FROM rules r WHERE {_MATCHES}) AS INT) AS sig FROM bin x""",
)
def signature_hits(spark, sf_dir):
    df = labelled(spark, sf_dir)
    return SignatureMiner(_DEFAULT).fit(df).transform(df).select("row_id", "sig")


def hybrid_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: mine the signatures, and report rule by rule what they flag and add to the ensemble."""
    table = labelled(spark, sf_dir)
    mined = SignatureMiner(_DEFAULT).fit(table)
    scored = table.withColumn("p_c", F.round(F.col("duration") / F.lit(7.0), 6))  # as in the view of scores
    report = ensemble.rule_report(mined, scored, "p_c", 0.5, "label").withColumnRenamed("rank", "place")
    return mined.rules(spark).join(report, F.col("rank") == F.col("place")).select(
        "rank", "rule", "support", "confidence", "match_count", "n_hits", "n_attacks", "n_only_this_rule", "n_beyond_ensemble"
    )


query(
    "hybrid_summary",
    f"""{WITH_BIN}, {_rules_ctes('bin', 'label', _CATEGORICAL, ['land'], _DEFAULT)},
    hits AS (SELECT x.row_id, x.label AS y, ROUND(x.duration / CAST(7 AS DOUBLE), 6) AS p_c, r.rank AS hit_rank
      FROM bin x JOIN rules r ON ({_MATCHES})),
    counted AS (SELECT *, count(*) OVER (PARTITION BY row_id) AS k FROM hits),
    report AS (SELECT hit_rank, count(*) AS n_hits, count(*) FILTER (WHERE y = 1) AS n_attacks,
      count(*) FILTER (WHERE k = 1) AS n_only_this_rule, count(*) FILTER (WHERE p_c < 0.5) AS n_beyond_ensemble
      FROM counted GROUP BY hit_rank)
    SELECT {_RULE_COLUMNS}, coalesce(n_hits, 0) AS n_hits, coalesce(n_attacks, 0) AS n_attacks,
      coalesce(n_only_this_rule, 0) AS n_only_this_rule, coalesce(n_beyond_ensemble, 0) AS n_beyond_ensemble
    FROM rules LEFT JOIN report ON hit_rank = rank""",
)(hybrid_summary)


_FUSED_LABEL = "CASE WHEN sig = 1 OR p_c >= 0.5 THEN 1 ELSE 0 END"

# --- voting --------------------------------------------------------------------

_MODELS = ["a", "b", "c"]
_WEIGHTS = (3.0, 2.0, 1.0)


def _with_labels(df: DataFrame) -> DataFrame:
    return df.withColumns({f"pred_{m}": cells.decide(F.col(f"p_{m}"), 0.5) for m in _MODELS})


_W = ("CAST(0.5 AS DOUBLE)", "CAST(2.0 AS DOUBLE) / 6", "CAST(1.0 AS DOUBLE) / 6")


@query(
    "weighted_shares",
    f"{WITH_SCORES} "
    + " UNION ALL ".join(
        f"SELECT row_id, '{m}' AS model, round(p_{m} * {w}, 9) AS value FROM scores" for m, w in zip(_MODELS, _W)
    ),
)
def weighted_shares(spark, sf_dir):
    weights = votes.normalised_weights(3, _WEIGHTS)
    scored = views.scores(spark, sf_dir)
    shares = scored.withColumns({f"share_{m}": F.col(f"p_{m}") * F.lit(w) for m, w in zip(_MODELS, weights)})
    return rounded(ensemble.model_outputs(shares, "row_id", _MODELS, "share_"), 9)


_MEAN = " + ".join(f"p_{m} * {w}" for m, w in zip(_MODELS, _W))
_MEAN_NORMAL = " + ".join(f"(1 - p_{m}) * {w}" for m, w in zip(_MODELS, _W))


@query("ensemble_probability", f"{WITH_SCORES} SELECT row_id, round({_MEAN}, 9) AS p_ensemble FROM scores")
def ensemble_probability(spark, sf_dir):
    voted = ensemble.with_votes(views.scores(spark, sf_dir), _MODELS, EnsembleSettings("soft", _WEIGHTS))
    return rounded(voted.select("row_id", "p_ensemble"), 9)


@query(
    "soft_vote",
    f"{WITH_SCORES} SELECT row_id, CASE WHEN {_MEAN} > {_MEAN_NORMAL} THEN 1 ELSE 0 END AS vote FROM scores",
)
def soft_vote(spark, sf_dir):
    voted = ensemble.with_votes(views.scores(spark, sf_dir), _MODELS, EnsembleSettings("soft", _WEIGHTS))
    return voted.select("row_id", "vote")


def _hard_sql(models: list[str], weights: list[str]) -> str:
    one = " + ".join(f"CASE WHEN p_{m} >= 0.5 THEN {w} ELSE 0 END" for m, w in zip(models, weights))
    zero = " + ".join(f"CASE WHEN p_{m} < 0.5 THEN {w} ELSE 0 END" for m, w in zip(models, weights))
    return f"{WITH_SCORES} SELECT row_id, CASE WHEN {one} > {zero} THEN 1 ELSE 0 END AS vote FROM scores"


@query("hard_vote", _hard_sql(_MODELS, ["1", "1", "1"]))
def hard_vote(spark, sf_dir):
    voted = ensemble.with_votes(_with_labels(views.scores(spark, sf_dir)), _MODELS, EnsembleSettings("hard"))
    return voted.select("row_id", "vote")


@query("hard_vote_with_draws", _hard_sql(["a", "b"], ["1", "1"]))
def hard_vote_with_draws(spark, sf_dir):
    voted = ensemble.with_votes(_with_labels(views.scores(spark, sf_dir)), ["a", "b"], EnsembleSettings("hard"))
    return voted.select("row_id", "vote")


@query(
    "model_predictions",
    f"{WITH_SCORES} "
    + " UNION ALL ".join(f"SELECT row_id, '{m}' AS model, CAST(p_{m} >= 0.5 AS INT) AS value FROM scores" for m in _MODELS),
)
def model_predictions(spark, sf_dir):
    return ensemble.model_outputs(_with_labels(views.scores(spark, sf_dir)), "row_id", _MODELS, "pred_")


@query(
    "model_probabilities",
    f"{WITH_SCORES} "
    + " UNION ALL ".join(f"SELECT row_id, '{m}' AS model, p_{m} AS value FROM scores" for m in _MODELS),
)
def model_probabilities(spark, sf_dir):
    return ensemble.model_outputs(views.scores(spark, sf_dir), "row_id", _MODELS, "p_")


# --- fusion --------------------------------------------------------------------


@query("fused_probability", f"{WITH_SCORES} SELECT row_id, CASE WHEN sig = 1 THEN 0.99::DOUBLE ELSE p_c END AS p_attack FROM scores")
def fused_probability(spark, sf_dir):
    return ensemble.with_fusion(views.scores(spark, sf_dir), "sig", "p_c", 0.5).select("row_id", "p_attack")


@query("fused_label", f"{WITH_SCORES} SELECT row_id, {_FUSED_LABEL} AS prediction FROM scores")
def fused_label(spark, sf_dir):
    return ensemble.with_fusion(views.scores(spark, sf_dir), "sig", "p_c", 0.5).select("row_id", "prediction")


@query(
    "fused_label_strict",
    f"{WITH_SCORES} SELECT row_id, CASE WHEN sig = 1 OR p_c >= CAST(0.995 AS DOUBLE) THEN 1 ELSE 0 END AS prediction FROM scores",
)
def fused_label_strict(spark, sf_dir):
    return ensemble.with_fusion(views.scores(spark, sf_dir), "sig", "p_c", 0.995).select("row_id", "prediction")


@query(
    "fusion_report",
    f"""{WITH_SCORES} SELECT count(*) AS n_records, count(*) FILTER (WHERE sig = 1) AS n_signature_hits,
      avg(CAST(sig AS DOUBLE)) AS signature_hit_rate, CAST(sum({_FUSED_LABEL}) AS BIGINT) AS n_flagged,
      count(*) FILTER (WHERE sig = 0 AND p_c >= 0.5) AS n_flagged_by_ensemble_only, CAST(0.5 AS DOUBLE) AS threshold,
      CAST(count(*) FILTER (WHERE sig = 1 AND y = 1) AS DOUBLE) / count(*) FILTER (WHERE y = 1) AS attacks_hit_by_signatures,
      CAST(count(*) FILTER (WHERE {_FUSED_LABEL} = y) AS DOUBLE) / count(*) AS accuracy FROM scores""",
)
def fusion_report(spark, sf_dir):
    return ensemble.fusion_report(views.scores(spark, sf_dir), "sig", "p_c", 0.5, "y")


@query(
    "predictions_with_confidence",
    f"""{WITH_SCORES}, fused AS (SELECT row_id, {_FUSED_LABEL} AS prediction,
      CASE WHEN sig = 1 THEN 0.99::DOUBLE ELSE p_c END AS p FROM scores)
    SELECT row_id, prediction, CASE WHEN prediction = 1 THEN 'Attack' ELSE 'Normal' END AS verdict,
      greatest(p, 1 - p) AS confidence FROM fused""",
)
def predictions_with_confidence(spark, sf_dir):
    fused = ensemble.with_fusion(views.scores(spark, sf_dir), "sig", "p_c", 0.5)
    return fused.select(
        "row_id",
        "prediction",
        cells.verdict(F.col("prediction")).alias("verdict"),
        cells.confidence(F.col("p_attack")).alias("confidence"),
    )


# --- evaluation ----------------------------------------------------------------

_FUSED = f"""{WITH_SCORES}, fused AS (SELECT row_id, y, {_FUSED_LABEL} AS prediction,
  CASE WHEN sig = 1 THEN 0.99::DOUBLE ELSE p_c END AS p FROM scores)"""


def _fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ensemble.with_fusion(views.scores(spark, sf_dir), "sig", "p_c", 0.5).select("row_id", "y", "prediction", "p_attack")


def _auc_sql(table: str, p: str) -> str:
    return f"""(SELECT round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 9) FROM (
      SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT {p} AS p, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg FROM {table} GROUP BY 1)))"""


def _metrics_sql(table: str, prediction: str, p: str, extra: str = "", lead: str = "") -> str:
    return f"""SELECT {lead}round((tp + tn) / (tp + tn + fp + fn), 9) AS accuracy,
      round(coalesce(tp / nullif(tp + fp, 0), 0), 9) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 9) AS recall,
      round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 9) AS f1, {_auc_sql(table, p)} AS roc_auc{extra}
    FROM (SELECT CAST(count(*) FILTER (WHERE y = 1 AND {prediction} = 1) AS DOUBLE) AS tp,
      CAST(count(*) FILTER (WHERE y = 0 AND {prediction} = 1) AS DOUBLE) AS fp,
      CAST(count(*) FILTER (WHERE y = 1 AND {prediction} = 0) AS DOUBLE) AS fn,
      CAST(count(*) FILTER (WHERE y = 0 AND {prediction} = 0) AS DOUBLE) AS tn FROM {table})"""


@query("evaluation_metrics", f"{_FUSED} {_metrics_sql('fused', 'prediction', 'p')}")
def evaluation_metrics(spark, sf_dir):
    return rounded(evaluate.metrics(_fused(spark, sf_dir), "y", "prediction", "p_attack"), 9)


_SUMMARY_EXTRA = """, round(coalesce(tp / nullif(tp + fn, 0), 0), 9) AS sensitivity,
  round(coalesce(tn / nullif(tn + fp, 0), 0), 9) AS specificity, CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp,
  CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp"""


@query("metrics_summary", f"{_FUSED} {_metrics_sql('fused', 'prediction', 'p', _SUMMARY_EXTRA)}")
def metrics_summary(spark, sf_dir):
    return rounded(evaluate.metrics_summary(_fused(spark, sf_dir), "y", "prediction", "p_attack"), 9)


_LABELLED_MODELS = f"""{WITH_SCORES}, labelled AS (SELECT y, p_a, p_b, p_c,
  {', '.join(f'CAST(p_{m} >= 0.5 AS INT) AS pred_{m}' for m in _MODELS)} FROM scores)"""
_COMPARED = " UNION ALL ".join(
    _metrics_sql("labelled", f"pred_{m}", f"p_{m}", lead=f"'{m}' AS model, ") for m in _MODELS
)


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = {m: (cells.decide(F.col(f"p_{m}"), 0.5), F.col(f"p_{m}")) for m in _MODELS}
    return evaluate.compare_models(views.scores(spark, sf_dir), "y", models)


@query("model_comparison", f"{_LABELLED_MODELS} {_COMPARED}")
def model_comparison(spark, sf_dir):
    return rounded(_compared(spark, sf_dir), 9)


@query(
    "stacked_results",
    f"""{_FUSED}, sweep AS (SELECT CAST(0.5 AS DOUBLE) AS threshold)
    SELECT *, CAST(NULL AS DOUBLE) AS threshold FROM ({_metrics_sql('fused', 'prediction', 'p', lead="'fused' AS model, ")})
    UNION ALL SELECT 'setting', NULL, NULL, NULL, NULL, NULL, threshold FROM sweep""",
)
def stacked_results(spark, sf_dir):
    setting = spark.createDataFrame([(0.5,)], "threshold double")
    fused = evaluate.metrics(_fused(spark, sf_dir), "y", "prediction", "p_attack")
    return rounded(evaluate.stack_results({"fused": fused, "setting": setting}), 9)


@query(
    "metric_bars",
    f"{_LABELLED_MODELS} SELECT model, metric, value FROM ({_COMPARED}) "
    "UNPIVOT (value FOR metric IN (accuracy, precision, recall, f1, roc_auc))",
)
def metric_bars(spark, sf_dir):
    return rounded(evaluate.metric_bars(_compared(spark, sf_dir)), 9)


_GUESS = """CASE WHEN flag = 'S0' THEN 'syn_flood' WHEN land = 1 THEN 'land_loop' WHEN flag = 'REJ' THEN 'reject_scan'
  WHEN duration = 6 THEN 'probe' WHEN flag IS NULL THEN NULL ELSE 'normal' END"""


@query(
    "confusion_cells",
    f"""{WITH_CONN}, guessed AS (SELECT label AS actual, {_GUESS} AS predicted FROM conn),
    cells AS (SELECT actual, predicted, count(*) AS n FROM guessed GROUP BY ALL
      UNION ALL SELECT DISTINCT actual, actual, 0 FROM guessed UNION ALL SELECT DISTINCT predicted, predicted, 0 FROM guessed)
    SELECT actual, predicted, CAST(sum(n) AS BIGINT) AS n FROM cells GROUP BY actual, predicted""",
)
def confusion_cells(spark, sf_dir):
    guessed = views.conn(spark, sf_dir).select("label", F.expr(_GUESS).alias("guess"))
    return evaluate.confusion_cells(guessed, "label", "guess")


@query(
    "confusion_matrix",
    f"""{_FUSED} SELECT y AS actual, count(*) FILTER (WHERE prediction = 0) AS predicted_0,
      count(*) FILTER (WHERE prediction = 1) AS predicted_1 FROM fused GROUP BY y""",
)
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(_fused(spark, sf_dir), "y", "prediction")


_REPORT = """classes AS (SELECT name AS class, tp, support, coalesce(tp / nullif(predicted, 0), 0) AS precision,
    coalesce(tp / nullif(support, 0), 0) AS recall, coalesce(2 * tp / nullif(support + predicted, 0), 0) AS f1
  FROM (SELECT name, CAST(count(*) FILTER (WHERE y = c AND prediction = c) AS DOUBLE) AS tp,
      CAST(count(*) FILTER (WHERE y = c) AS DOUBLE) AS support, CAST(count(*) FILTER (WHERE prediction = c) AS DOUBLE) AS predicted
    FROM fused, (VALUES (0, 'Normal'), (1, 'Attack')) AS names(c, name) GROUP BY name))"""


@query(
    "classification_report",
    f"""{_FUSED}, {_REPORT}, shown AS (SELECT class, precision, recall, f1, support FROM classes
    UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM classes
    UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM classes
    UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
      sum(f1 * support) / sum(support), sum(support) FROM classes)
    SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1,
      CAST(support AS BIGINT) AS support FROM shown""",
)
def classification_report(spark, sf_dir):
    return rounded(evaluate.classification_report(_fused(spark, sf_dir), "y", "prediction"), 9)


@query("roc_auc", f"{_FUSED} SELECT {_auc_sql('fused', 'p')} AS roc_auc")
def roc_auc(spark, sf_dir):
    return rounded(evaluate.roc_auc(_fused(spark, sf_dir), "y", "p_attack"), 9)


# The order total is a score with almost as many values as rows.
_ORDERS = """orders_scored AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, o_totalprice AS p FROM orders)"""


def _orders_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("y"), F.col("o_totalprice").alias("p")
    )


@query("roc_auc_many_scores", f"WITH {_ORDERS} SELECT {_auc_sql('orders_scored', 'p')} AS roc_auc")
def roc_auc_many_scores(spark, sf_dir):
    return rounded(evaluate.roc_auc(_orders_scored(spark, sf_dir), "y", "p"), 9)


def _curve_ctes(table: str) -> str:
    return f"""steps AS (SELECT p, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg FROM {table} GROUP BY p),
    summed AS (SELECT p, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS positives,
      sum(neg) OVER () AS negatives, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg,
      row_number() OVER w AS place FROM steps WINDOW w AS (ORDER BY p DESC))"""


def _roc_sql(kept: str) -> str:
    return f"""SELECT p AS threshold, CAST(fp AS DOUBLE) / negatives AS fpr, CAST(tp AS DOUBLE) / positives AS tpr
    FROM summed WHERE {kept} UNION ALL SELECT CAST('Infinity' AS DOUBLE), 0.0, 0.0"""


_BENDS = "place = 1 OR next_pos IS NULL OR pos <> next_pos OR neg <> next_neg"


@query("roc_curve", f"{_FUSED}, {_curve_ctes('fused')} {_roc_sql(_BENDS)}")
def roc_curve(spark, sf_dir):
    return evaluate.roc_curve(_fused(spark, sf_dir), "y", "p_attack")


@query("roc_curve_many_scores", f"WITH {_ORDERS}, {_curve_ctes('orders_scored')} {_roc_sql(_BENDS)}")
def roc_curve_many_scores(spark, sf_dir):
    return evaluate.roc_curve(_orders_scored(spark, sf_dir), "y", "p")


@query("roc_curve_every_point", f"{_FUSED}, {_curve_ctes('fused')} {_roc_sql('TRUE')}")
def roc_curve_every_point(spark, sf_dir):
    return evaluate.roc_curve(_fused(spark, sf_dir), "y", "p_attack", drop_collinear=False)


_MODEL_CURVES = " UNION ALL ".join(
    f"SELECT '{m}' AS model, threshold, fpr, tpr FROM (WITH {_curve_ctes(f'(SELECT y, p_{m} AS p FROM scores)')} "
    f"{_roc_sql(_BENDS)})"
    for m in _MODELS
)


@query("model_roc_curves", f"{WITH_SCORES} {_MODEL_CURVES}")
def model_roc_curves(spark, sf_dir):
    models = {m: (F.lit(0), F.col(f"p_{m}")) for m in _MODELS}
    long = evaluate.long_scores(views.scores(spark, sf_dir), "y", models)
    return evaluate.roc_curve(long, "y", "score", by=("model",))


@query(
    "model_precision_recall_curves",
    f"{WITH_SCORES} "
    + " UNION ALL ".join(
        f"""SELECT '{m}' AS model, threshold, precision, recall FROM (
        WITH {_curve_ctes(f'(SELECT y, p_{m} AS p FROM scores)')}
        SELECT p AS threshold, CAST(tp AS DOUBLE) / (tp + fp) AS precision, CAST(tp AS DOUBLE) / positives AS recall
        FROM summed UNION ALL SELECT CAST(NULL AS DOUBLE), 1.0, 0.0)"""
        for m in _MODELS
    ),
)
def model_precision_recall_curves(spark, sf_dir):
    models = {m: (F.lit(0), F.col(f"p_{m}")) for m in _MODELS}
    long = evaluate.long_scores(views.scores(spark, sf_dir), "y", models)
    return evaluate.precision_recall_curve(long, "y", "score", by=("model",))


@query(
    "precision_recall_curve",
    f"""{_FUSED}, {_curve_ctes('fused')} SELECT p AS threshold, CAST(tp AS DOUBLE) / (tp + fp) AS precision,
      CAST(tp AS DOUBLE) / positives AS recall FROM summed UNION ALL SELECT CAST(NULL AS DOUBLE), 1.0, 0.0""",
)
def precision_recall_curve(spark, sf_dir):
    return evaluate.precision_recall_curve(_fused(spark, sf_dir), "y", "p_attack")


_GRID = ", ".join(f"({t!r}::DOUBLE)" for t in evaluate.threshold_grid())
_SWEEP = f"""{_FUSED}, grid(threshold) AS (VALUES {_GRID}),
  tried AS (SELECT threshold, CAST(count(*) FILTER (WHERE p >= threshold AND y = 1) AS DOUBLE) AS tp,
    CAST(count(*) FILTER (WHERE p >= threshold AND y = 0) AS DOUBLE) AS fp, CAST(sum(y) AS DOUBLE) AS positives
  FROM grid, fused GROUP BY threshold)"""
_SWEPT = {
    "f1": "coalesce(2 * tp / nullif(tp + fp + positives, 0), 0)",
    "precision": "coalesce(tp / nullif(tp + fp, 0), 0)",
    "recall": "coalesce(tp / nullif(positives, 0), 0)",
}


def _threshold_queries(metric: str) -> None:
    value = _SWEPT[metric]

    @query(f"threshold_sweep_{metric}", f"{_SWEEP} SELECT threshold, {value} AS value FROM tried")
    def sweep(spark, sf_dir):
        return evaluate.threshold_sweep(_fused(spark, sf_dir), "y", "p_attack", metric)

    @query(
        f"best_threshold_{metric}",
        f"{_SWEEP} SELECT threshold, {value} AS value FROM tried ORDER BY value DESC, threshold LIMIT 1",
    )
    def best(spark, sf_dir):
        return evaluate.best_threshold(_fused(spark, sf_dir), "y", "p_attack", metric)


for _metric in _SWEPT:
    _threshold_queries(_metric)


@query(
    "per_class_metrics",
    f"""{WITH_CONN}, codes AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS code FROM (SELECT DISTINCT label FROM conn)),
    guessed AS (SELECT code AS y, CASE WHEN duration < 6 THEN code ELSE 3 END AS prediction FROM conn JOIN codes USING (label))
    SELECT c.label AS class,
      round(coalesce(CAST(count(*) FILTER (WHERE y = code AND prediction = code) AS DOUBLE)
        / nullif(count(*) FILTER (WHERE prediction = code), 0), 0), 9) AS precision,
      round(coalesce(CAST(count(*) FILTER (WHERE y = code AND prediction = code) AS DOUBLE)
        / nullif(count(*) FILTER (WHERE y = code), 0), 0), 9) AS recall,
      round(coalesce(CAST(2 * count(*) FILTER (WHERE y = code AND prediction = code) AS DOUBLE)
        / nullif(count(*) FILTER (WHERE y = code) + count(*) FILTER (WHERE prediction = code), 0), 0), 9) AS f1
    FROM guessed, codes c GROUP BY c.label""",
)
def per_class_metrics(spark, sf_dir):
    conn = views.conn(spark, sf_dir)
    codes = LabelCodes("label").fit(conn)
    guessed = codes.encode(conn, "y").withColumn(
        "prediction", F.when(F.col("duration") < 6, F.col("y")).otherwise(F.lit(3))
    )
    return rounded(evaluate.per_class_metrics(guessed, "y", "prediction", codes.mapping), 9)


@query(
    "class_chart",
    f"""{WITH_CONN} SELECT label AS class, count(*) AS count,
      round(count(*) * 100.0 / (SELECT count(*) FROM conn), 1) AS percentage FROM conn GROUP BY label""",
)
def class_chart(spark, sf_dir):
    return evaluate.class_chart(views.conn(spark, sf_dir), "label")


@query(
    "importance_chart",
    f"""{WITH_CONN} SELECT 'duration' AS feature, round((sum(n * (m - g) * (m - g)) / (count(*) - 1))
      / (sum(n * v) / (sum(n) - count(*))), 4) AS score
    FROM (SELECT count(*) AS n, avg(duration) AS m, var_pop(duration) AS v, (SELECT avg(duration) FROM conn) AS g
      FROM conn GROUP BY label <> 'normal') UNION ALL
    SELECT 'serror_rate', round((sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))), 4)
    FROM (SELECT count(*) AS n, avg(serror_rate) AS m, var_pop(serror_rate) AS v, (SELECT avg(serror_rate) FROM conn) AS g
      FROM conn GROUP BY label <> 'normal')""",
)
def importance_chart(spark, sf_dir):
    chosen = ["duration", "serror_rate"]
    ranked = features.ranked_importance(labelled(spark, sf_dir), chosen, "label")
    return rounded(evaluate.importance_chart(ranked), 4)


# --- learners and jobs ---------------------------------------------------------

class _Training:
    """The training job with the default settings on the three parts of a table.

    A learner is fitted when it is first needed, alone or beside others, and kept: its fit depends on nothing of the
    others', so a query about one learner gets the same model as the whole job.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        train, self.validation, self.test = sampling.three_way_split(labelled(spark, sf_dir), row_id="row_id", label="label")
        self.prepared = jobs.Preparation(train)
        self.models: dict[str, Model] = {}
        self.scored: dict[str, DataFrame] = {}

    def fitted(self, *names: str) -> dict[str, Model]:
        self.models |= self.prepared.learners(names, self.models)
        return {n: self.models[n] for n in names}

    def learner(self, name: str) -> Model:
        return self.fitted(name)[name]

    @cached_property
    def test_vectors(self) -> DataFrame:
        detector = jobs.Detector(self.prepared.preprocess, self.prepared.features, {}, DetectorSettings().ensemble)
        return cut_lineage(detector.prepared(self.test).select("label", learners.FEATURES), "vectors")

    def scored_test(self, name: str) -> DataFrame:
        """``label, p_<name>, pred_<name>`` of the test rows."""
        if name not in self.scored:
            found = learners.score_with({name: self.learner(name)}, self.test_vectors).drop(learners.FEATURES)
            self.scored[name] = cut_lineage(found, "scored")
        return self.scored[name]

    @cached_property
    def run(self) -> jobs.TrainingRun:
        """The whole job, with all five learners."""
        models = self.fitted(*learners.FITTERS)
        return jobs.train_detector(self.prepared, validation=self.validation, test=self.test, trained=models)


_trainings: dict[tuple[str, str], _Training] = {}


def _training(spark: SparkSession, sf_dir: str) -> _Training:
    """Once per session and table."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _trainings:
        _trainings[key] = _Training(spark, sf_dir)
    return _trainings[key]


def _run(spark: SparkSession, sf_dir: str) -> jobs.TrainingRun:
    return _training(spark, sf_dir).run


def _stacked(run: jobs.TrainingRun) -> DataFrame:
    return evaluate.stack_results({k: v.withColumnRenamed("model", "learner") for k, v in run.results.items()})


_TEST_ROWS = "CAST(ceil(0.2 * count(*)) AS BIGINT)"


def _learner_queries(name: str) -> None:
    @query(f"learner_{name}")
    def metrics_of(spark, sf_dir):
        scored = _training(spark, sf_dir).scored_test(name)
        return evaluate.metrics(scored, "label", f"pred_{name}", f"p_{name}")

    @query(
        f"learner_{name}_holdout",
        f"{WITH_CONN} SELECT {_TEST_ROWS} AS n, CAST(0 AS BIGINT) AS odd_p, CAST(0 AS BIGINT) AS odd_pred, true AS ranks FROM conn",
    )
    def holdout(spark, sf_dir):
        scored = _training(spark, sf_dir).scored_test(name)
        p, pred = F.col(f"p_{name}"), F.col(f"pred_{name}")
        auc = evaluate.roc_auc(scored, "label", f"p_{name}").first()[0]
        inside = F.coalesce((p >= 0) & (p <= 1), F.lit(False))
        agrees = pred.isin(0, 1)
        if name != "kernel_machine":  # its label is the sign of the margin, its probability a calibration of it
            agrees = agrees & ((p == 0.5) | (pred == (p > 0.5).cast("int")))
        agrees = F.coalesce(agrees, F.lit(False))
        return scored.agg(
            F.count(F.lit(1)).alias("n"), F.count_if(~inside).alias("odd_p"), F.count_if(~agrees).alias("odd_pred")
        ).withColumn("ranks", F.lit(auc >= 0.7))


for _name in learners.FITTERS:
    _learner_queries(_name)


@query("learner_importance")
def learner_importance(spark, sf_dir):
    training = _training(spark, sf_dir)
    return learners.learner_importance(training.learner("random_forest"), training.prepared.features.output_columns, spark)


@query("learner_importance_linear")
def learner_importance_linear(spark, sf_dir):
    training = _training(spark, sf_dir)
    return learners.learner_importance(training.learner("logistic_regression"), training.prepared.features.output_columns, spark)


@query("training_job")
def training_job(spark, sf_dir):
    return _stacked(_run(spark, sf_dir))


def _reused(spark: SparkSession, sf_dir: str) -> jobs.TrainingRun:
    """A second job without signatures on the same parts, with the learners of the first."""
    train, validation, test = sampling.three_way_split(labelled(spark, sf_dir), row_id="row_id", label="label")
    settings = DetectorSettings(fusion=FusionSettings(use_signatures=False))
    trained = _run(spark, sf_dir).detector.learners
    return jobs.train_detector(train, validation=validation, test=test, settings=settings, trained=trained)


@query("training_job_without_signatures")
def training_job_without_signatures(spark, sf_dir):
    return _stacked(_reused(spark, sf_dir))


@query(
    "reused_learners",
    f"{WITH_CONN} SELECT {_TEST_ROWS} AS n, CAST(0 AS BIGINT) AS differing, CAST(0 AS BIGINT) AS with_signature FROM conn",
)
def reused_learners(spark, sf_dir):
    first = _run(spark, sf_dir).scored_test
    names = [f"p_{m}" for m in learners.FITTERS]
    second = _reused(spark, sf_dir).scored_test.select(F.col("row_id").alias("id"), "sig", *[F.col(n).alias(f"{n}_again") for n in names])
    same = [F.round(n, 9).eqNullSafe(F.round(f"{n}_again", 9)) for n in names]
    agree = same[0]
    for s in same[1:]:
        agree = agree & s
    return first.select("row_id", *names).join(second, F.col("row_id") == F.col("id"), "full").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~agree).alias("differing"), F.count_if(F.col("sig") != 0).alias("with_signature")
    )


@query("training_run_summary")
def training_run_summary(spark, sf_dir):
    path = scratch_path(spark, "runs")
    runs.append_summary(jobs.run_summary(_run(spark, sf_dir), "run-1"), path)
    return runs.last_summary(spark, path)


def _trained(spark: SparkSession, sf_dir: str) -> jobs.Detector:
    return _run(spark, sf_dir).detector


_SAME = f"{WITH_CONN} SELECT count(*) AS n, 0 AS differing FROM conn"


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    a = left.select("row_id", "prediction", F.round("p_attack", 12).alias("p"))
    b = right.select(F.col("row_id").alias("id"), F.col("prediction").alias("other"), F.round("p_attack", 12).alias("q"))
    return a.join(b, F.col("row_id") == F.col("id"), "full").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~(F.col("prediction").eqNullSafe(F.col("other")) & F.col("p").eqNullSafe(F.col("q"))))
        .cast("int")
        .alias("differing"),
    )


def _all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table to be scored; each row goes through five learners."""
    return on_all_cores(labelled(spark, sf_dir))


@query("reloaded_detector", _SAME)
def reloaded_detector(spark, sf_dir):
    detector = _trained(spark, sf_dir)
    path = scratch_path(spark, "detector")
    jobs.save_detector(detector, spark, path)
    df = _all_rows(spark, sf_dir)
    return _differing(detector.score(df), jobs.score_table(spark, path, df))


@query("arriving_files_scored", _SAME)
def arriving_files_scored(spark, sf_dir):
    detector = _trained(spark, sf_dir)
    df = _all_rows(spark, sf_dir)
    folder, output = scratch_path(spark, "arriving"), scratch_path(spark, "scored")
    df.write.parquet(folder)
    stream = arriving(spark, folder, df.schema)
    score_arriving(detector, stream, output, scratch_path(spark, "progress")).awaitTermination()
    return _differing(detector.score(df), spark.read.parquet(output))


_PARTS = ["features", *[f"learners/{m}" for m in learners.FITTERS], "manifest", "preprocess", "rules", "signatures", "threshold"]


@query("artifact_list", "SELECT * FROM (VALUES " + ", ".join(f"('{p}')" for p in _PARTS) + ") AS parts(artifact)")
def artifact_list(spark, sf_dir):
    path = scratch_path(spark, "detector")
    jobs.save_detector(_trained(spark, sf_dir), spark, path)
    return jobs.list_artifacts(spark, path)


def _from_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows, scored by the detector as it was stored and loaded again."""
    path = scratch_path(spark, "detector")
    jobs.save_detector(_trained(spark, sf_dir), spark, path)
    return jobs.score_table(spark, path, _all_rows(spark, sf_dir))


@query("batch_inference")
def batch_inference(spark, sf_dir):
    scored = jobs.with_actual(_from_artifacts(spark, sf_dir), "label")
    return scored.select("row_id", "sig", "prediction", "verdict", "actual", F.round("confidence", 6).alias("confidence"))


@query(
    "batch_inference_holds",
    f"""{WITH_BIN} SELECT count(*) AS n, CAST(0 AS BIGINT) AS odd_p, CAST(0 AS BIGINT) AS hits_not_certain,
      CAST(0 AS BIGINT) AS odd_models FROM bin""",
)
def batch_inference_holds(spark, sf_dir):
    scored = _from_artifacts(spark, sf_dir)
    inside = lambda c: F.coalesce((F.col(c) >= 0) & (F.col(c) <= 1), F.lit(False))
    models = inside("p_ensemble")
    for m in learners.FITTERS:
        models = models & inside(f"p_{m}") & F.col(f"pred_{m}").isin(0, 1)
    return scored.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~inside("p_attack")).alias("odd_p"),
        F.count_if((F.col("sig") == 1) & ((F.col("p_attack") != 0.99) | (F.col("prediction") != 1))).alias("hits_not_certain"),
        F.count_if(~models).alias("odd_models"),
    )


@query("batch_report")
def batch_report(spark, sf_dir):
    scored = _trained(spark, sf_dir).score(_all_rows(spark, sf_dir))
    report = jobs.batch_report(scored, "label")
    totals = report["totals"].select(F.col("verdict").alias("key"), F.col("n").cast("double").alias("value"))
    return totals.unionByName(
        report["metrics"].unpivot([], ["accuracy", "precision", "recall", "f1", "roc_auc"], "key", "value")
    )


@query("predictions_of_every_model")
def predictions_of_every_model(spark, sf_dir):
    return _trained(spark, sf_dir).predict(_all_rows(spark, sf_dir).drop("label"), "all")


@query("detector_summary")
def detector_summary(spark, sf_dir):
    return _trained(spark, sf_dir).summary(spark)
