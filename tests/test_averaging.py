import math

import numpy as np
import pytest

from conftest import rows
from betainc import betainc
from hubcast.operators.averaging import (ensemble_average, min_models, weighted_mean,
                                         weighted_median)
from hubcast.operators.skill import skill_weights

KEYS = "target_variable string, horizon int, temporal_resolution string, target_end_date date, " \
       "location string, type string, quantile double"


def _ens_input(spark, values):
    return spark.createDataFrame(
        [(f"m{i}", "inc case", 1, "wk", None, "L", "quantile", 0.5, v) for i, v in enumerate(values)],
        "model string, " + KEYS + ", value double")


def test_mean_and_median(spark):  # fixture 10
    assert rows(ensemble_average(_ens_input(spark, [1.0, 2.0, 6.0]), "mean"), "value", "forecasts") == [(3.0, 3)]
    assert rows(ensemble_average(_ens_input(spark, [1.0, 2.0, 6.0, 8.0]), "median"), "value") == [(4.0,)]


def test_mean_propagates_null(spark):  # fixture 11
    assert rows(ensemble_average(_ens_input(spark, [1.0, None]), "mean"), "value") == [(None,)]


def test_min_models_counts_distinct_models(spark):  # fixture 30
    df = spark.createDataFrame(
        [("a", "L", 1, "wk", "inc case", None, 1.0), ("a", "L", 1, "wk", "inc case", None, 2.0),
         ("a", "M", 1, "wk", "inc case", None, 1.0), ("b", "M", 1, "wk", "inc case", None, 2.0)],
        "model string, location string, horizon int, temporal_resolution string, "
        "target_variable string, target_end_date date, value double")
    assert rows(min_models(df, 2), "location", "model") == [("M", "a"), ("M", "b")]


def test_inverse_skill_weights(spark):  # fixture 12
    ev = spark.createDataFrame(
        [(m, 5, "inc case", 1, "L", s) for m, s in (("A", 0.5), ("B", 1.0), ("C", 0.0))],
        "model string, continuous_weeks int, target_variable string, horizon int, location string, rel_wis double")
    fc = spark.createDataFrame([(m,) for m in "ABC"], "model string")
    w = dict(rows(skill_weights(fc, ev), "model", "weight"))
    assert w["A"] == pytest.approx(2 / 3) and w["B"] == pytest.approx(1 / 3) and w["C"] == 0.0


def _weighted(spark, xs, ws):
    return spark.createDataFrame([("k", float(x), float(w)) for x, w in zip(xs, ws)],
                                 "k string, value double, weight double")


def test_weighted_mean(spark):  # fixtures 13, 14
    out = rows(weighted_mean(["k"], _weighted(spark, [10, 40, 99], [2 / 3, 1 / 3, 0.0])), "value", "n_models")
    assert out[0][0] == pytest.approx(20.0) and out[0][1] == 3
    assert rows(weighted_mean(["k"], _weighted(spark, [10, 99], [2 / 3, 0.0])), "value")[0][0] == pytest.approx(10.0)


@pytest.mark.parametrize("ws,hd,t7", [([1, 1, 1], 61 / 27, 2.0), ([2, 1, 1], 1.836135, 1.5)])
def test_weighted_median(spark, ws, hd, t7):  # fixtures 15, 16, 16b
    df = _weighted(spark, [1.0, 2.0, 4.0], [float(w) for w in ws])
    assert rows(weighted_median(["k"], df), "value")[0][0] == pytest.approx(hd, abs=1e-6)
    assert rows(weighted_median(["k"], df, estimator="type7"), "value")[0][0] == pytest.approx(t7)


def _hd_numpy(x, w, p=0.5):
    o = np.argsort(x)
    x, w = np.asarray(x, float)[o], np.asarray(w, float)[o]
    n = w.sum() ** 2 / (w ** 2).sum()
    c = np.concatenate([[0.0], np.cumsum(w / w.sum())])
    a, b = p * (n + 1), (1 - p) * (n + 1)
    return float((np.diff(betainc(c, [a] * len(c), [b] * len(c))) * x).sum())


def test_weighted_median_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    data, expected = [], {}
    for g in range(25):
        k = int(rng.integers(1, 9))
        xs, ws = rng.normal(size=k).round(3), rng.uniform(0.05, 1.0, size=k).round(3)
        expected[f"g{g}"] = _hd_numpy(xs, ws)
        data += [(f"g{g}", float(x), float(w)) for x, w in zip(xs, ws)]
    df = spark.createDataFrame(data, "k string, value double, weight double")
    got = dict(rows(weighted_median(["k"], df), "k", "value"))
    assert all(math.isclose(got[k], v, abs_tol=1e-9) for k, v in expected.items())


def test_weighted_median_of_many_members(spark):
    """Up to 300 members, equal, slanted and lopsided weights: the quadrature holds to 11 digits."""
    rng = np.random.default_rng(11)
    data, expected = [], {}
    for g, k in enumerate([2, 3, 30, 150, 300] * 3):
        xs = rng.normal(size=k).round(3)
        ws = [np.ones(k), rng.uniform(0.05, 1.0, size=k).round(3), np.append([float(k)], rng.uniform(0.01, 0.02, size=k - 1))][g % 3]
        expected[f"g{g}"] = _hd_numpy(xs, ws)
        data += [(f"g{g}", float(x), float(w)) for x, w in zip(xs, ws)]
    found = weighted_median(["k"], spark.createDataFrame(data, "k string, value double, weight double"))
    got = dict(rows(found, "k", "value"))
    assert all(math.isclose(got[k], v, abs_tol=1e-11) for k, v in expected.items()), [(got[k] - v) for k, v in expected.items()]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Window" not in plan


@pytest.mark.parametrize("estimator", ["harrell_davis", "type7"])
def test_members_of_weight_zero_only(spark, estimator):
    df = spark.createDataFrame([("z", 1.0, 0.0), ("z", 2.0, 0.0), ("k", 5.0, 1.0), ("k", 9.0, 0.0)],
                               "k string, value double, weight double")
    got = {r.k: (r.value, r.n_models) for r in weighted_median(["k"], df, estimator=estimator).collect()}
    assert got["z"] == (None, 2) and got["k"][0] == pytest.approx(5.0)
    means = {r.k: r.value for r in weighted_mean(["k"], df).collect()}
    assert means == {"z": None, "k": 5.0}


@pytest.mark.parametrize("a", [0.6, 1.0, 2.5, 7.0])
def test_incomplete_beta_against_its_integral(a):
    """Midpoint sums of the density, an evaluation of its own."""
    x = np.array([0.0, 0.1, 0.37, 0.5, 0.8, 0.99, 1.0])
    t = (np.arange(400_000) + 0.5) / 400_000
    u = t * t * (3 - 2 * t)  # puts the points closer at both ends, where the density can be steep
    density = u ** (a - 1) * (1 - u) ** (a - 1) * 6 * t * (1 - t)
    total = density.sum()
    want = [density[u <= v].sum() / total for v in x]
    assert np.allclose(betainc(x, a, a), want, atol=2e-5)
