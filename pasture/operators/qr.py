"""Least squares by a mergeable QR factorisation.

Moments square the condition number: with nearly collinear features (day of year and lactation days) half of the digits
are gone before anything is solved.  A triangular factor of ``[1 X y]`` keeps them, and two factors merge into one by
factorising them on top of each other, so blocks of rows are reduced where they lie:

1. every Arrow batch gives one factor per group (k + 2 rows at most, whatever the batch holds);
2. factors are merged within (group, salt), then within the group, each time by one running factor over sorted rows.

A task holds one batch and one factor.  A group with a third of all rows is reduced by all tasks first and merged by
``SALTS`` of them, and the last merge takes at most ``SALTS`` factors a group.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

SALTS = 32
RCOND = 1e-13          # singular values below this share of the largest count as zero (rank-deficient features)
_FACTOR = [T.StructField("n", T.LongType()), T.StructField("r", T.ArrayType(T.DoubleType()))]


def _triangle(m: np.ndarray, width: int) -> np.ndarray:
    r = np.linalg.qr(m, mode="r")
    out = np.zeros((width, width))
    out[:len(r)] = r
    return out


def _merge(factors: DataFrame, by: Sequence[str], width: int) -> DataFrame:
    """One factor per ``by``: rows of a key are neighbours, so one running factor is all a task holds."""
    by = list(by)
    x = factors.repartition(*by).sortWithinPartitions(*by) if by else factors.repartition(1)     # SALTS rows at most

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, n, acc = None, 0, None
        for f in frames:
            out = []
            for *k, fn, fr in f[[*by, "n", "r"]].itertuples(index=False, name=None):
                k = tuple(None if pd.isna(v) else v for v in k)
                r = np.asarray(fr, dtype=float).reshape(width, width)
                if acc is not None and k == key:
                    n, acc = n + fn, _triangle(np.vstack([acc, r]), width)
                    continue
                if acc is not None:
                    out.append((*key, n, acc.ravel()))
                key, n, acc = k, fn, r
            yield pd.DataFrame(out, columns=[*by, "n", "r"])
        if acc is not None:
            yield pd.DataFrame([(*key, n, acc.ravel())], columns=[*by, "n", "r"])

    keys = [f for f in factors.schema.fields if f.name in by]
    return x.select(*by, "n", "r").mapInPandas(run, T.StructType([*sorted(keys, key=lambda f: by.index(f.name)), *_FACTOR]))


def qr_factors(df: DataFrame, y: str, xs: Sequence[str], group: Sequence[str] = (), salts: int = SALTS) -> DataFrame:
    """Per group: number of complete rows and the triangular factor of ``[1 xs y]``, row by row in one array.

    Rows with a null or NaN in ``y`` or ``xs`` are left out; a null group is a group of its own.
    """
    group, cols = list(group), [*xs, y]
    width = len(cols) + 1
    x = df.select(*group, *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(cols)])
    values = [f"_v{i}" for i in range(len(cols))]
    x = x.dropna(subset=values)

    def block(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            parts = f.groupby(group, dropna=False, sort=False) if group else [((), f)]
            out = []
            for k, g in parts:
                if len(g):
                    m = np.column_stack([np.ones(len(g)), g[values].to_numpy(dtype=float)])
                    out.append((*(None if pd.isna(v) else v for v in k), len(g), _triangle(m, width).ravel()))
            yield pd.DataFrame(out, columns=[*group, "n", "r"])

    keys = [x.schema[g] for g in group]
    factors = x.mapInPandas(block, T.StructType([*keys, *_FACTOR]))
    # rows of a task have the same salt, whatever their order, so a repeated task gives the same rows
    factors = factors.withColumn("_salt", F.spark_partition_id() % salts)
    return _merge(_merge(factors, [*group, "_salt"], width).drop("_salt"), group, width)


def ols_fit_qr(df: DataFrame, y: str, xs: Sequence[str], group: Sequence[str] = (), min_rows: int = 3) -> DataFrame:
    """Least-squares fit per group (n, intercept, r2, b_<x>…): as ``stats.ols_fit``, without squaring the condition number.

    Below the row of the constant, a factor is that of the centred features; their minimum-norm solution is taken, as a
    least-squares solver does on rank-deficient data.  A group whose target is constant has r2 1 (nothing left to explain)
    or 0.  Groups of fewer than ``min_rows`` complete rows give no row.
    """
    group, k = list(group), len(xs)
    factors = qr_factors(df, y, xs, group).filter(F.col("n") >= min_rows)
    names = [*group, "n", "intercept", "r2", *[f"b_{c}" for c in xs]]
    schema = T.StructType([*[factors.schema[g] for g in group], T.StructField("n", T.LongType()),
                           *[T.StructField(c, T.DoubleType()) for c in names[len(group) + 1:]]])

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for *key, n, flat in f[[*group, "n", "r"]].itertuples(index=False, name=None):
                r = np.asarray(flat, dtype=float).reshape(k + 2, k + 2)
                centred, z = r[1:, 1:-1], r[1:, -1]
                beta = np.linalg.lstsq(centred, z, rcond=RCOND)[0]
                intercept = (r[0, -1] - r[0, 1:-1] @ beta) / r[0, 0]
                sse, sst = float(np.sum((z - centred @ beta) ** 2)), float(z @ z)
                # a target that is constant but for rounding has nothing to explain
                flat_target = sst <= (1e-14 * r[0, -1]) ** 2
                r2 = (1.0 if sse < 1e-12 else 0.0) if flat_target else 1.0 - sse / sst
                out.append((*key, n, intercept, r2, *beta))
            yield pd.DataFrame(out, columns=names)

    return factors.mapInPandas(solve, schema)
