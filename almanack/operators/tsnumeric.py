"""Features that need a recursion, a transform or a fit: grouped pandas.

A group is one period of a daily series (at most 366 rows), so a group always
fits a task; Spark partitions and shuffles the groups.
"""

import numpy as np
import pandas as pd

GROUPED = ["y_pacf5", "diff1y_pacf5", "diff2y_pacf5", "seas_pacf1", "entropy", "holt_alpha"]
SCHEMA = "series string, period string, feature string, value double"
GRID = np.round(np.arange(0.05, 1.0, 0.05), 2)


def autocorrelation(x, lags):
    """Biased autocorrelation at lags 0 … lags; None for a constant series."""
    c = x - x.mean()
    total = float(c @ c)
    if len(x) <= lags or total <= 0:
        return None
    return np.array([float(c[k:] @ c[: len(c) - k]) / total for k in range(lags + 1)])


def partial_autocorrelation(x, lags):
    """Lags 1 … lags by solving the Yule-Walker system of each order."""
    r = autocorrelation(x, lags)
    if r is None:
        return None
    out = []
    for k in range(1, lags + 1):
        system = r[np.abs(np.subtract.outer(np.arange(k), np.arange(k)))]
        out.append(float(np.linalg.lstsq(system, r[1 : k + 1], rcond=None)[0][-1]))
    return np.array(out)


def sum_of_squares(x, lags):
    p = partial_autocorrelation(x, lags)
    return None if p is None else float((p ** 2).sum())


def spectral_entropy(x):
    """Entropy of the periodogram in [0, 1]; 0 when there is no variation."""
    power = np.abs(np.fft.rfft(x - x.mean())) ** 2
    power = power[1:]
    if len(power) < 2 or power.sum() <= 1e-12:
        return 0.0
    p = power / power.sum()
    p = p[p > 0]
    return float(-(p * np.log2(p)).sum() / np.log2(len(power)))


def holt_level(x):
    """Smoothing level of the linear-trend smoother with the least one-step error
    over a grid of level and trend factors; the smallest level wins a tie."""
    if len(x) < 4:
        return None
    alpha, beta = (g.ravel() for g in np.meshgrid(GRID, GRID, indexing="ij"))
    level = np.full(alpha.shape, x[0])
    trend = np.full(alpha.shape, x[1] - x[0])
    error = np.zeros(alpha.shape)
    for v in x[1:]:
        expected = level + trend
        error += (v - expected) ** 2
        moved = alpha * v + (1 - alpha) * expected
        trend = beta * (moved - level) + (1 - beta) * trend
        level = moved
    return float(alpha[int(np.argmin(error))])


def _seasonal(x):
    found = partial_autocorrelation(x, 7)
    return None if found is None else float(found[6])


def _differenced(times):
    def feature(x):
        d = np.diff(x, times)
        return sum_of_squares(d, 5) if len(d) else None

    return feature


FEATURES = {
    "y_pacf5": lambda x: sum_of_squares(x, 5),
    "diff1y_pacf5": _differenced(1),
    "diff2y_pacf5": _differenced(2),
    "seas_pacf1": _seasonal,
    "entropy": spectral_entropy,
    "holt_alpha": holt_level,
}


def _one_period(names, key, pdf):
    x = pdf.sort_values("date")["value"].to_numpy(dtype=float)
    values = {n: FEATURES[n](x) for n in names}
    return pd.DataFrame(
        {
            "series": key[0], "period": key[1], "feature": list(values),
            "value": pd.array(list(values.values()), dtype="Float64"),
        }
    )


def grouped_features(df, names=tuple(FEATURES)):
    """Long ``(series, period, feature, value)`` of the named features, and only they
    are computed; input as for the native features."""
    names = tuple(names)
    return (
        df.where("value IS NOT NULL")
        .select("series", "period", "date", "value")
        .groupBy("series", "period")
        .applyInPandas(lambda key, pdf: _one_period(names, key, pdf), SCHEMA)
    )
