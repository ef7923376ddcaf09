"""The preprocessing stage: impute, de-duplicate, filter, encode, scale."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade.config import PreprocessSettings
from palisade.functions.cells import null_if_missing
from palisade.operators.cleaning import drop_outliers, fill_values, first_of_each, impute, outlier_bounds
from palisade.operators.encoding import categories, indicator_name, indicators, scaled, scaling
from palisade.operators.fitted import HasState
from palisade.schema import categorical_columns, numeric_columns, quoted
from palisade.session import cut_lineage


def booleans_as_int(df: DataFrame) -> DataFrame:
    flags = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    return df.withColumns({c: F.col(quoted(c)).cast("int") for c in flags}) if flags else df


class Preprocessor(Estimator, HasState):
    """Learns from training rows; ``row_id`` identifies a row and ``label`` is its class."""

    def __init__(self, settings: PreprocessSettings | None = None, row_id: str = "row_id", label: str = "label"):
        super().__init__()
        self.with_state({"settings": asdict(settings or PreprocessSettings()), "row_id": row_id, "label": label})

    def fit_rows(self, df: DataFrame) -> tuple[PreprocessModel, DataFrame]:
        """The fitted model and the raw training rows that survive, as one materialised table."""
        s = PreprocessSettings(**self.learned["settings"])
        row_id, label = self.learned["row_id"], self.learned["label"]
        df = booleans_as_int(df)
        numeric = numeric_columns(df, exclude=(row_id, label))
        categorical = categorical_columns(df, exclude=(row_id, label))

        fills = fill_values(df, numeric, categorical, s.missing)
        rows = cut_lineage(first_of_each(df, [*numeric, *categorical], row_id, label, fills), "survivors")
        bounds = outlier_bounds(impute(rows, fills), numeric, s.outliers, s.iqr_multiplier)
        rows = drop_outliers(rows, bounds, fills)

        clean = impute(rows, fills)
        levels = categories(clean, categorical, s.max_categories)
        spans = scaling(clean, numeric, s.scaling) if s.scale else {}
        model = PreprocessModel().with_state(
            {
                "numeric": numeric,
                "categorical": categorical,
                "fills": fills,
                "bounds": {c: list(b) for c, b in bounds.items()},
                "levels": levels,
                "spans": {c: list(v) for c, v in spans.items()},
                "row_id": row_id,
                "label": label,
            }
        )
        return model, rows

    def _fit(self, dataset: DataFrame) -> PreprocessModel:
        return self.fit_rows(dataset)[0]


class PreprocessModel(Model, HasState):
    """Row-preserving replay: nothing is de-duplicated or filtered here."""

    @property
    def output_columns(self) -> list[str]:
        s = self.learned
        return [*s["numeric"], *[indicator_name(c, v) for c, values in s["levels"].items() for v in values]]

    @property
    def input_columns(self) -> list[str]:
        return [*self.learned["numeric"], *self.learned["categorical"]]

    def training_rows(self, df: DataFrame) -> DataFrame:
        """The raw rows that training keeps: first of each imputed duplicate, inside the bounds."""
        s = self.learned
        unique = first_of_each(booleans_as_int(df), self.input_columns, s["row_id"], s["label"], s["fills"])
        return drop_outliers(unique, {c: tuple(b) for c, b in s["bounds"].items()}, s["fills"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        s = self.learned
        df = booleans_as_int(dataset)
        absent = [c for c in self.input_columns if c not in df.columns]
        if absent:
            raise ValueError(f"input lacks the columns {absent}")
        features = set(self.input_columns)
        kept = [F.col(quoted(c)) for c in df.columns if c not in features]
        clean = impute(df, s["fills"])
        numbers = [
            scaled(c, *s["spans"][c]) if c in s["spans"] else F.col(quoted(c)).cast("double").alias(c)
            for c in s["numeric"]
        ]
        return clean.select(*kept, *numbers, *indicators(s["levels"]))


def gaps_left(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: cells still missing in the given columns."""
    return df.agg(
        sum((F.count_if(null_if_missing(df, c).isNull()) for c in columns), F.lit(0)).alias("missing")
    )
