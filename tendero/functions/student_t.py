"""Student-t tail and quantile as Arrow UDFs over aggregated rows.

Spark has no t distribution.  With x = sqrt(df) * tan(a) the density becomes a power of a
cosine, so P(|T| <= t) is the integral of cos(a)^(df-1) from 0 to atan(t / sqrt(df)), divided by
the integral up to pi/2.  A Gauss-Legendre rule evaluates it for a whole batch at once.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(160)
_UNIT_NODES, _UNIT_WEIGHTS = (_NODES + 1.0) / 2.0, _WEIGHTS / 2.0
_PANELS = 6


def _scale(df: np.ndarray) -> np.ndarray:
    """2 * Gamma((df+1)/2) / (sqrt(pi) * Gamma(df/2))."""
    logs = np.array([math.lgamma((v + 1) / 2) - math.lgamma(v / 2) for v in df])
    return 2.0 * np.exp(logs) / math.sqrt(math.pi)


def _cosine_power(lo: np.ndarray, hi: np.ndarray, df: np.ndarray) -> np.ndarray:
    width = (hi - lo) / _PANELS
    total = np.zeros_like(df)
    for panel in range(_PANELS):
        angle = (lo + panel * width)[:, None] + width[:, None] * _UNIT_NODES[None, :]
        cosine = np.clip(np.cos(angle), 1e-300, None)
        total += width * (np.exp((df[:, None] - 1.0) * np.log(cosine)) @ _UNIT_WEIGHTS)
    return total


def two_sided_p(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(|T| >= |t|).  Small t integrates the centre, large t the tail, to keep precision."""
    angle = np.arctan(np.abs(t) / np.sqrt(df))
    centre = 1.0 - _scale(df) * _cosine_power(np.zeros_like(angle), angle, df)
    # The integrand falls off within a few 1/sqrt(df) of its start; stop where it is negligible.
    end = np.minimum(np.full_like(angle, math.pi / 2), np.arctan((np.abs(t) + 60.0) / np.sqrt(df)))
    end = np.where(df < 30.0, math.pi / 2, end)
    tail = _scale(df) * _cosine_power(angle, end, df)
    return np.clip(np.where(np.abs(t) < 2.0, centre, tail), 0.0, 1.0)


def critical_value(df: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    """The c with P(|T| >= c) = alpha: grow a bracket until it holds, then halve it."""
    low, high = np.zeros_like(df), np.full_like(df, 2.0)
    while np.any(open_ends := (two_sided_p(high, df) > alpha) & (high < 1e12)):
        high = np.where(open_ends, high * 2.0, high)
    for _ in range(100):
        middle = (low + high) / 2.0
        above = two_sided_p(middle, df) > alpha
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return (low + high) / 2.0


def _where_valid(compute, first: pd.Series, second: pd.Series, df: pd.Series) -> pd.Series:
    a, b = first.to_numpy(float), second.to_numpy(float)
    valid = np.isfinite(a) & np.isfinite(b) & (df.to_numpy(float) > 0)
    out = np.full(len(a), np.nan)
    if valid.any():
        out[valid] = compute(a[valid], b[valid])
    return pd.Series(out, dtype="float64").astype("Float64").where(valid, pd.NA)


@F.pandas_udf(T.DoubleType())
def t_two_sided_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return _where_valid(two_sided_p, t, df, df)


@F.pandas_udf(T.DoubleType())
def t_critical(df: pd.Series, alpha: pd.Series) -> pd.Series:
    return _where_valid(critical_value, df, alpha, df)
