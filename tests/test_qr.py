"""Least squares by mergeable QR against numpy, where moments lose their digits."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pasture.operators import qr, stats


def frame(n=600, seed=3):
    rnd = np.random.default_rng(seed)
    a = rnd.normal(100, 10, n)
    b = a * 2 + 1e-6 * rnd.normal(size=n)                 # condition number about 1e8 once centred
    g = np.where(rnd.random(n) < 0.4, "hot", rnd.integers(0, 12, n).astype(str))
    return pd.DataFrame({"g": g, "a": a, "b": b, "y": 3 + 5 * a - 2 * b + 1e-9 * rnd.normal(size=n)})


def numpy_fit(p, xs):
    x, y = p[xs].to_numpy(float), p["y"].to_numpy(float)
    beta = np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=1e-13)[0]
    return y.mean() - x.mean(0) @ beta, beta


@pytest.mark.parametrize("group", [[], ["g"]])
def test_fits_of_condition_1e8_agree_with_numpy_and_moments_do_not(spark, group):
    p = frame()
    df = spark.createDataFrame(p).repartition(7)
    got = {r["g"] if group else None: r for r in qr.ols_fit_qr(df, "y", ["a", "b"], group).collect()}
    want = {k[0]: g for k, g in p.groupby(["g"])} if group else {None: p}
    assert set(got) == {k for k, g in want.items() if len(g) >= 3}
    for k, r in got.items():
        _, beta = numpy_fit(want[k], ["a", "b"])
        assert r["n"] == len(want[k]) and np.allclose([r["b_a"], r["b_b"]], beta, rtol=0, atol=0.02) and r["r2"] > 1 - 1e-12
        assert abs(r["b_a"] - 5) < 0.05 and abs(r["b_b"] + 2) < 0.05
    if not group:
        m = stats.ols_fit(df, "y", ["a", "b"]).first()
        assert abs(m["b_a"] - 5) > 1


def test_rank_deficient_constant_null_and_small_groups(spark):
    rows = [("x", float(i), 2.0 * i, 7.0 + i) for i in range(6)] + [("x", None, 1.0, 1.0), ("x", 1.0, float("nan"), 1.0)]
    rows += [("flat", float(i), 1.0, 4.0) for i in range(4)] + [("two", 1.0, 1.0, 1.0), ("two", 2.0, 1.0, 1.0)]
    rows += [(None, float(i), float(i * i), 1.0 + i * i) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, a double, b double, y double").withColumn("n", F.lit("clash")).withColumn("r", F.lit(1))
    got = {r["g"]: r for r in qr.ols_fit_qr(df, "y", ["a", "b"], ["g"]).collect()}
    assert set(got) == {"x", "flat", None} and got["x"]["n"] == 6
    assert np.allclose([got["x"]["b_a"], got["x"]["b_b"], got["x"]["intercept"]], [0.2, 0.4, 7.0])       # minimum norm
    assert np.allclose([got["flat"]["b_a"], got["flat"]["b_b"], got["flat"]["intercept"]], [0, 0, 4])
    assert np.allclose([got[None]["b_a"], got[None]["b_b"], got[None]["intercept"], got[None]["r2"]], [0, 1, 1, 1])
    assert qr.ols_fit_qr(df.limit(0), "y", ["a", "b"], ["g"]).count() == 0
    assert qr.ols_fit_qr(df.limit(0), "y", ["a", "b"]).count() == 0
