"""Grouped statistics: Pearson correlation, least squares, trend slopes.

Everything is computed from per-group *moments* with built-in aggregates, so
the data is shuffled once by group and partially aggregated map-side; only
one small row per group (means and centred co-moments) reaches Python, where
a 7×7 system is solved.  No group's rows are ever collected into one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pasture.operators.joins import join_dimension


def _both(x: str, y: str) -> Column:
    return F.col(x).isNotNull() & F.col(y).isNotNull()


def pearson(x: str, y: str) -> Column:
    """Pairwise-complete Pearson r; NULL for a constant column (no ANSI divide error)."""
    b = _both(x, y)
    xs, ys = F.when(b, F.col(x).cast("double")), F.when(b, F.col(y).cast("double"))
    return F.try_divide(F.covar_pop(xs, ys), F.sqrt(F.var_pop(xs) * F.var_pop(ys)))


def correlation_long(df: DataFrame, cols: Sequence[str], group: Sequence[str] = (),
                     target: str | None = None, digits: int = 6) -> DataFrame:
    """Correlation matrix in long form ``(group…, feature_x, feature_y, r, n)``.

    With ``target`` only the target's column of the matrix is produced.  The
    full matrix aggregates only the upper triangle (r and n are symmetric) and
    mirrors it; one aggregation computes every pair, an explode makes it long.
    """
    if target:
        out = [(target, c, i) for i, c in enumerate(cols)]
        pairs = [(target, c) for c in cols]
    else:
        idx = {(a, b): n for n, (a, b) in enumerate((a, b) for i, a in enumerate(cols) for b in cols[i:])}
        pairs = list(idx)
        out = [(a, b, idx[(a, b)] if (a, b) in idx else idx[(b, a)]) for a in cols for b in cols]
    aggs = []
    for i, (a, b) in enumerate(pairs):
        aggs.append(F.round(pearson(a, b), digits).alias(f"r{i}"))
        aggs.append(F.count_if(_both(a, b)).alias(f"n{i}"))
    wide = df.groupBy(*group).agg(*aggs) if group else df.agg(*aggs)
    stack = F.explode(F.array(*[F.struct(F.lit(a).alias("feature_x"), F.lit(b).alias("feature_y"),
                                          F.col(f"r{i}").alias("r"), F.col(f"n{i}").alias("n"))
                                 for a, b, i in out]))
    return wide.select(*group, stack.alias("p")).select(*group, "p.*")


# ------------------------------------------------------------------ least squares

def ols_moments(df: DataFrame, y: str, xs: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Per group: n, means and centred co-moments (``covar_pop``) of y and every x pair."""
    cols = [y, *xs]
    aggs = [F.count(F.lit(1)).alias("n")] + [F.avg(c).alias(f"m_{c}") for c in cols]
    for a, b in combinations_with_replacement(cols, 2):
        aggs.append(F.covar_pop(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c_{a}__{b}"))
    return (df.groupBy(*group).agg(*aggs)) if group else df.agg(*aggs)


def _solve_rows(pdf: pd.DataFrame, y: str, xs: Sequence[str], group: Sequence[str]) -> pd.DataFrame:
    cols = [y, *xs]
    k = len(xs)
    out = []
    for _, r in pdf.iterrows():
        cov = np.zeros((k + 1, k + 1))
        for i, a in enumerate(cols):
            for j, b in enumerate(cols):
                key = f"c_{a}__{b}" if f"c_{a}__{b}" in r.index else f"c_{b}__{a}"
                cov[i, j] = r[key]
        sxx, sxy, syy = cov[1:, 1:], cov[1:, 0], cov[0, 0]
        # minimum-norm solution of the centred normal equations: pinv(XᵀX)Xᵀy = pinv(X)y,
        # the same solution a least-squares solver returns on rank-deficient data
        beta = np.linalg.pinv(sxx, rcond=1e-12, hermitian=True) @ sxy
        means = np.array([r[f"m_{c}"] for c in xs])
        intercept = r[f"m_{y}"] - beta @ means
        sse = syy - 2 * beta @ sxy + beta @ sxx @ beta
        r2 = (1.0 - sse / syy) if syy > 0 else (1.0 if abs(sse) < 1e-12 else 0.0)
        row = {g: r[g] for g in group}
        row.update({"n": int(r["n"]), "intercept": float(intercept), "r2": float(r2)})
        row.update({f"b_{c}": float(v) for c, v in zip(xs, beta)})
        out.append(row)
    cols_out = [*group, "n", "intercept", "r2", *[f"b_{c}" for c in xs]]
    return pd.DataFrame(out, columns=cols_out)


def ols_fit(df: DataFrame, y: str, xs: Sequence[str], group: Sequence[str] = (), min_rows: int = 3) -> DataFrame:
    """Least-squares fit per group (intercept, coefficients, R²), minimum-norm.

    Moments are Spark aggregates; the solve runs in ``mapInPandas`` over one
    row per group (a k×k system), so Python never sees the data rows.
    """
    m = ols_moments(df, y, xs, group).filter(F.col("n") >= min_rows)
    gfields = [f for f in m.schema.fields if f.name in group]
    schema = T.StructType([*gfields, T.StructField("n", T.LongType()), T.StructField("intercept", T.DoubleType()),
                           T.StructField("r2", T.DoubleType()),
                           *[T.StructField(f"b_{c}", T.DoubleType()) for c in xs]])
    group = list(group)

    def solve(it):
        for pdf in it:
            yield _solve_rows(pdf, y, xs, group)

    return m.mapInPandas(solve, schema)


def predict(df: DataFrame, coefs: DataFrame, xs: Sequence[str], group: Sequence[str] = (),
            out: str = "predicted") -> DataFrame:
    """Score rows with their group's coefficients (coefficient table: one row per group).

    Grouped: an equi-join on the group key (size-checked broadcast).  Pooled:
    the single coefficient row is a scalar subquery, so no join at all.
    """
    names = ["intercept", *[f"b_{c}" for c in xs]]
    if group:
        j = join_dimension(df, coefs.select(*group, *names), list(group))
        b = {n: F.col(n) for n in names}
    else:
        j = df
        row = coefs.select(F.struct(*names).alias("c")).scalar()
        b = {n: row[n] for n in names}
    dot = b["intercept"]
    for c in xs:
        dot = dot + b[f"b_{c}"] * F.col(c)
    res = j.withColumn(out, dot)
    return res.drop(*names) if group else res


# ------------------------------------------------------------------ last rows, trends

def last_rows(df: DataFrame, group: Sequence[str], order: str, k: int = 7, rank: str = "_rk") -> DataFrame:
    """Tail-k per group (1 = newest).  ``row_number() <= k`` is planned as a
    WindowGroupLimit, so each map task keeps only k rows per group before the shuffle."""
    w = Window.partitionBy(*group).orderBy(F.col(order).desc())
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def trend_slopes(df: DataFrame, group: Sequence[str], order: str, features: Sequence[str],
                 k: int = 7, digits: int | None = 6) -> DataFrame:
    """Least-squares slope of each feature over the last k rows (x = 0..n−1)."""
    t = last_rows(df, group, order, k)
    x = (-F.col("_rk")).cast("double")   # same slope as 0..n-1 in date order
    aggs = [F.count(F.lit(1)).alias("n")]
    for f in features:
        s = F.regr_slope(F.col(f).cast("double"), x)
        # "+ 0.0" turns a signed zero into 0.0
        aggs.append(((F.round(s, digits) if digits is not None else s) + F.lit(0.0)).alias(f))
    return t.groupBy(*group).agg(*aggs)
