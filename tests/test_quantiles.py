import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from palisade.operators.quantiles import exact_quantiles

SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def frame(spark, **columns):
    rows = list(zip(*[[None if v is None else float(v) for v in c] for c in columns.values()]))
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(3)


def test_interpolated_and_discrete(spark):
    draw = np.random.default_rng(1)
    a, b = draw.normal(size=501), draw.integers(0, 5, size=501)
    got = exact_quantiles(frame(spark, a=a, b=b), ["a", "b"], SHARES)
    assert np.allclose(got["a"], np.quantile(a, SHARES), rtol=1e-12)
    assert np.allclose(got["b"], np.quantile(b, SHARES), rtol=1e-12)
    stored = exact_quantiles(frame(spark, a=a, b=b), ["a", "b"], SHARES, discrete=True)
    assert stored["a"] == list(np.quantile(a, SHARES, method="inverted_cdf"))


def test_missing_values_are_left_out(spark):
    got = exact_quantiles(frame(spark, a=[1, None, 3, float("nan")], b=[None] * 4), ["a", "b"], [0.5])
    assert got == {"a": [2.0], "b": [None]}


@pytest.mark.parametrize("kind", ["spread", "one_value_is_most", "ends", "two_values"])
def test_narrowing_is_exact(spark, kind):
    """A tiny limit forces the bracketing path; a coarse accuracy forces several rounds."""
    draw = np.random.default_rng(2)
    values = {
        "spread": draw.lognormal(sigma=4.0, size=4000),
        "one_value_is_most": np.where(draw.random(4000) < 0.7, 0.0, draw.normal(size=4000)),
        "ends": np.concatenate([np.full(1999, -1e9), draw.normal(size=2), np.full(1999, 1e9)]),
        "two_values": draw.integers(0, 2, size=4000).astype(float),
    }[kind]
    df = frame(spark, a=values, b=values[::-1] * 2)
    got = exact_quantiles(df, ["a", "b"], SHARES, value_limit=20, accuracy=50)
    assert np.allclose(got["a"], np.quantile(values, SHARES), rtol=1e-12)
    assert np.allclose(got["b"], np.quantile(values * 2, SHARES), rtol=1e-12)


def test_infinities_are_ordinary_values(spark):
    values = [float("-inf")] * 30 + list(range(40)) + [float("inf")] * 30
    got = exact_quantiles(frame(spark, a=values), ["a"], [0.1, 0.5, 0.9], discrete=True, value_limit=5, accuracy=20)
    assert got["a"] == [float("-inf"), 19.0, float("inf")]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60))
def test_any_values(spark, values):
    got = exact_quantiles(frame(spark, a=values), ["a"], [0.25, 0.5], value_limit=5, accuracy=20)
    assert np.allclose(got["a"], np.quantile(values, [0.25, 0.5]), rtol=1e-9, atol=1e-9)
