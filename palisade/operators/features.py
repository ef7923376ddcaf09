"""Feature scores, filters, derived columns and the feature stage."""

from __future__ import annotations

from dataclasses import asdict
from itertools import combinations

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palisade.config import CORRELATION_LIMIT, DERIVED_FEATURE_COLUMNS, VARIANCE_FLOOR, FeatureSettings
from palisade.functions.cells import align, finite_table
from palisade.operators.correlation import correlated_columns
from palisade.operators.fitted import HasState
from palisade.operators.neighbours import neighbour_information
from palisade.operators.quantiles import exact_quantiles
from palisade.schema import numeric_columns, quoted

INFORMATION_BINS = 10


def assemble(df: DataFrame, features: list[str], output: str = "features") -> DataFrame:
    """One vector column from named columns, whatever characters the names contain."""
    safe = [f"_f{i}" for i in range(len(features))]
    named = df.select("*", *[F.col(quoted(c)).alias(s) for c, s in zip(features, safe)])
    return VectorAssembler(inputCols=safe, outputCol=output).transform(named).drop(*safe)


def f_scores(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """(feature, score): the one-way ANOVA F statistic, from one aggregation per class.

    Constant columns and columns without any spread inside the classes score 0.
    """
    per_class = df.groupBy(F.col(quoted(label))).agg(
        F.count(F.lit(1)).alias("_n"),
        *[
            F.struct(
                F.avg(quoted(c)).alias("mean"),
                F.var_pop(quoted(c)).alias("var"),
                F.min(quoted(c)).alias("low"),
                F.max(quoted(c)).alias("high"),
            ).alias(f"_s{i}")
            for i, c in enumerate(features)
        ],
    )
    cells = per_class.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("feature"),
                        F.col("_n").cast("double").alias("n"),
                        F.col(f"_s{i}.mean").alias("mean"),
                        F.col(f"_s{i}.var").alias("var"),
                        F.col(f"_s{i}.low").alias("low"),
                        F.col(f"_s{i}.high").alias("high"),
                    )
                    for i, c in enumerate(features)
                ]
            )
        )
    )
    whole = Window.partitionBy("feature")
    grand = F.sum(F.col("n") * F.col("mean")).over(whole) / F.sum("n").over(whole)
    sums = (
        cells.withColumn("gap", F.col("mean") - grand)
        .groupBy("feature")
        .agg(
            F.count(F.lit(1)).alias("k"),
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.col("gap") * F.col("gap")).alias("between"),
            F.sum(F.col("n") * F.col("var")).alias("within"),
            (F.min("low") == F.max("high")).alias("constant"),
        )
    )
    between = F.try_divide(F.col("between"), F.col("k") - 1)
    within = F.try_divide(F.col("within"), F.col("n") - F.col("k"))
    score = F.when(F.col("constant"), F.lit(0.0)).otherwise(F.coalesce(F.try_divide(between, within), F.lit(0.0)))
    return sums.select("feature", score.alias("score"))


def information_scores(df: DataFrame, features: list[str], label: str, bins: int = INFORMATION_BINS) -> DataFrame:
    """(feature, score): mutual information in nats of the class and the quantile-binned feature.

    Bin borders are stored values (discrete quantiles); a value belongs to the bin given by the
    number of borders below it.
    """
    shares = [i / bins for i in range(1, bins)]
    borders = exact_quantiles(df, features, shares, discrete=True)

    def bin_of(c: str) -> Column:
        return sum(
            ((F.col(quoted(c)) > F.lit(b)).cast("int") for b in sorted({b for b in borders[c] if b is not None})),
            F.lit(0),
        )

    cells = (
        df.select(
            F.col(quoted(label)).alias("_y"),
            F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), bin_of(c).alias("bin")) for c in features])),
        )
        .groupBy("feature", "bin", "_y")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    total = F.sum("n").over(Window.partitionBy("feature"))
    of_bin = F.sum("n").over(Window.partitionBy("feature", "bin"))
    of_class = F.sum("n").over(Window.partitionBy("feature", "_y"))
    parts = cells.select("feature", "n", total.alias("t"), of_bin.alias("b"), of_class.alias("c"))
    part = F.col("n") / F.col("t") * F.log(F.col("n") * F.col("t") / (F.col("b") * F.col("c")))
    return parts.groupBy("feature").agg(F.greatest(F.sum(part), F.lit(0.0)).alias("score"))


def ranked_importance(df: DataFrame, features: list[str], label: str, method: str = "f_classif") -> DataFrame:
    """(feature, score), best first."""
    clean = finite_table(df, features)
    if method == "f_classif":
        scores = f_scores(clean, features, label)
    elif method == "mutual_info":
        scores = information_scores(clean, features, label)
    elif method == "mutual_info_neighbours":
        scores = neighbour_information(clean, features, label)
    else:
        raise ValueError(f"unknown importance method {method!r}")
    return scores.orderBy(F.desc("score"), "feature")


def variances(df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, variance) with the population variance."""
    wide = df.agg(*[F.var_pop(quoted(c)).alias(c) for c in features])
    return wide.unpivot([], [F.col(quoted(c)) for c in features], "feature", "variance")


def varying_features(df: DataFrame, features: list[str], floor: float = VARIANCE_FLOOR) -> list[str]:
    """Features whose variance is above the floor, in column order; none left is an error."""
    found = {r["feature"]: r["variance"] for r in variances(df, features).collect()}
    kept = [c for c in features if found[c] is not None and found[c] > floor]
    if not kept:
        raise ValueError("no feature varies")
    return kept


def reaching_variance(df: DataFrame, features: list[str], floor: float) -> DataFrame:
    """(feature, variance) of the features whose variance is at least the floor."""
    return variances(df, features).filter(F.col("variance") >= floor)


def uncorrelated_features(df: DataFrame, features: list[str], limit: float = CORRELATION_LIMIT) -> list[str]:
    """Features without too strong a correlation to *any* feature before them.

    A feature that is itself dropped still counts as one before them.
    """
    if len(features) < 2:
        return list(features)
    # At most one number per column comes to the driver.
    late = correlated_columns(df, features, limit).select("second").distinct().collect()
    dropped = {r["second"] for r in late}
    return [c for j, c in enumerate(features) if j not in dropped]


def derived_names(features: list[str], interactions: bool, squares: bool) -> tuple[list, list]:
    """Products and squares of the leading columns, as (a, b, name) and (column, name)."""
    lead = features[:DERIVED_FEATURE_COLUMNS]
    products = [[a, b, f"{a}_x_{b}"] for a, b in combinations(lead, 2)] if interactions else []
    powers = [[c, f"{c}_pow_2"] for c in lead] if squares else []
    return products, powers


def with_derived(df: DataFrame, products: list, powers: list) -> DataFrame:
    new = {name: F.col(quoted(a)) * F.col(quoted(b)) for a, b, name in products}
    new.update({name: F.col(quoted(c)) * F.col(quoted(c)) for c, name in powers})
    return df.withColumns(new) if new else df


def best_features(df: DataFrame, features: list[str], label: str, k: int | str) -> list[str]:
    """The k best features by F score in column order; among equals the later column wins."""
    if k == "all" or int(k) >= len(features):
        return list(features)
    score = {r["feature"]: r["score"] for r in f_scores(df, features, label).collect()}
    order = sorted(range(len(features)), key=lambda i: (score[features[i]], i), reverse=True)
    chosen = set(order[: int(k)])
    return [c for i, c in enumerate(features) if i in chosen]


class FeatureEngineer(Estimator, HasState):
    """Learns which numeric columns to keep, derive and select."""

    def __init__(self, settings: FeatureSettings | None = None, row_id: str = "row_id", label: str = "label"):
        super().__init__()
        self.with_state({"settings": asdict(settings or FeatureSettings()), "row_id": row_id, "label": label})

    def _fit(self, dataset: DataFrame) -> FeatureModel:
        s = FeatureSettings(**self.learned["settings"])
        row_id, label = self.learned["row_id"], self.learned["label"]
        inputs = numeric_columns(dataset, exclude=(row_id, label))
        clean = finite_table(dataset.select(*[F.col(quoted(c)) for c in [label, *inputs]]), inputs)
        kept = uncorrelated_features(clean, varying_features(clean, inputs))
        products, powers = derived_names(kept, s.interactions, s.squares)
        derived = with_derived(clean, products, powers)
        candidates = [*kept, *[p[2] for p in products], *[p[1] for p in powers]]
        return FeatureModel().with_state(
            {
                "inputs": inputs,
                "kept": kept,
                "products": products,
                "powers": powers,
                "selected": best_features(derived, candidates, label, s.k),
                "row_id": row_id,
                "label": label,
            }
        )


class FeatureModel(Model, HasState):
    @property
    def output_columns(self) -> list[str]:
        return list(self.learned["selected"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        s = self.learned
        inputs = set(s["inputs"])
        keep = tuple(c for c in dataset.columns if c not in inputs)
        aligned = align(dataset, s["kept"], keep)
        derived = with_derived(finite_table(aligned, s["kept"]), s["products"], s["powers"])
        return derived.select(
            *[F.col(quoted(c)) for c in keep], *[F.col(quoted(c)) for c in s["selected"]]
        )
