"""Fits and forecasts recomputed with NumPy on the real sf0.001 frames."""

import numpy as np
import pandas as pd

import __spark_entry__ as E
from pasture.plans import analytics as A
from pasture.plans import q_analytics as QA

from conftest import SF_SMALL

Q = E.queries()


def _lstsq(pdf, features):
    X = np.c_[np.ones(len(pdf)), pdf[list(features)].astype(float).to_numpy()]
    y = pdf[A.TARGET].astype(float).to_numpy()
    return np.linalg.lstsq(X, y, rcond=None)[0]


def test_ols_pooled_matches_numpy(spark):
    pooled = QA._pooled(spark, SF_SMALL).toPandas()
    coef = _lstsq(pooled, A.POOLED_FEATURES)
    r = A.ols_pooled(QA._pooled(spark, SF_SMALL)).first()
    got = [r["intercept"], *[r[f"b_{c}"] for c in A.POOLED_FEATURES]]
    X = np.c_[np.ones(len(pooled)), pooled[list(A.POOLED_FEATURES)].astype(float).to_numpy()]
    # compare fitted values (robust to near-collinear coefficient trade-offs)
    assert np.allclose(X @ np.array(got), X @ coef, rtol=1e-6, atol=1e-6)
    assert r["n"] == len(pooled)


def test_ols_per_device_and_forecasts_match_numpy(spark):
    clean = QA._clean(spark, SF_SMALL).toPandas().sort_values(["device_alias", "date"])
    fits = {r["device_alias"]: r for r in A.ols_per_device(QA._clean(spark, SF_SMALL)).collect()}
    assert set(fits) == set(clean["device_alias"])
    avg = {(r["device_alias"], r["date"]): r["predicted"] for r in Q["forecast_avg"](spark, SF_SMALL).collect()}
    trend = {(r["device_alias"], r["date"]): r["predicted"] for r in Q["forecast_trend"](spark, SF_SMALL).collect()}
    scen = {(r["device_alias"], r["date"], r["scenario"]): r["predicted"]
            for r in Q["forecast_scenario"](spark, SF_SMALL).collect()}
    last7 = {(r["device_alias"], r["date"]): r["predicted"] for r in Q["last7_fit"](spark, SF_SMALL).collect()}
    feats = list(A.DEVICE_FEATURES)
    for dev, g in clean.groupby("device_alias"):
        g = g.reset_index(drop=True)
        X = np.c_[np.ones(len(g)), g[feats].astype(float).to_numpy()]
        coef = _lstsq(g, feats)
        f = fits[dev]
        mine = np.array([f["intercept"], *[f[f"b_{c}"] for c in feats]])
        assert np.allclose(X @ mine, X @ coef, rtol=1e-6, atol=1e-5), dev
        predict = lambda row: float(mine[0] + np.dot(mine[1:], row))
        tail = g.tail(7)
        last_date = g["date"].max()
        # approach 1: mean of the last 7 rows for 7 days
        m = tail[feats].astype(float).mean().to_numpy()
        assert abs(avg[(dev, last_date + pd.Timedelta(days=1))] - predict(m)) < 1e-6
        # approach 3: last row, kWh × (1 + adj), day of year + i
        base = g.iloc[-1][feats].astype(float).to_numpy()
        for name, adj in A.SCENARIOS:
            row = base.copy()
            row[0] = base[0] * (1 + adj)
            row[-1] = base[-1] + 3
            assert abs(scen[(dev, last_date + pd.Timedelta(days=3), name)] - predict(row)) < 1e-6
        # approach 4: last value + polyfit slope × i
        slopes = np.array([np.polyfit(np.arange(len(tail)), tail[c].astype(float).to_numpy(), 1)[0]
                           if len(tail) > 1 else 0.0 for c in feats])
        assert abs(trend[(dev, last_date + pd.Timedelta(days=2))] - predict(base + 2 * slopes)) < 1e-5
        # In-sample last 7 only for devices with ≥ 7 rows
        if len(g) >= 7:
            for _, row in tail.iterrows():
                assert abs(last7[(dev, row["date"])] - predict(row[feats].astype(float).to_numpy())) < 1e-6
        else:
            assert not any(k[0] == dev for k in last7)
