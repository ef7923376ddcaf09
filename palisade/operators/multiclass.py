"""Attack-type labels: a stored code per class name, in both directions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from palisade.operators.encoding import code_table, decode_with, encode_with


class LabelCodes:
    """Sorted class names numbered from 0; fit once, then encode and decode."""

    def __init__(self, label: str):
        self.label = label
        self._codes: DataFrame | None = None

    def fit(self, df: DataFrame) -> LabelCodes:
        self._codes = code_table(df, [self.label])
        return self

    @property
    def mapping(self) -> DataFrame:
        """(value, code)"""
        if self._codes is None:
            raise ValueError("label codes have not been fitted")
        return self._codes.select("value", "code")

    def encode(self, df: DataFrame, output: str) -> DataFrame:
        self.mapping
        return encode_with(df, self._codes, self.label, output)

    def decode(self, df: DataFrame, code: str, output: str) -> DataFrame:
        self.mapping
        return decode_with(df, self._codes, self.label, code, output)
