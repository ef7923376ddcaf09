"""Shared base of the fitted stages: state is JSON, so pyspark.ml can save and load it."""

from __future__ import annotations

from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable


class HasState(Params, DefaultParamsReadable, DefaultParamsWritable):
    state = Param(Params._dummy(), "state", "what was learned or configured", TypeConverters.identity)

    def with_state(self, value: dict):
        return self._set(state=value)

    @property
    def learned(self) -> dict:
        if not self.isSet(self.state):
            raise ValueError(f"{type(self).__name__} has not been fitted")
        return self.getOrDefault(self.state)
