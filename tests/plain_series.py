"""Plain numpy versions of the series tests: least squares per lag order, and
the Durbin-Levinson recursion."""

import math

import numpy as np

TAU = (2.74, -18.83, -1.61)
SMALL, LARGE = [2.1659, 1.4412, 0.038269], [1.7339, 0.93202, -0.12745, -0.010368]


def pvalue(stat):
    if stat > TAU[0]:
        return 1.0
    if stat < TAU[1]:
        return 0.0
    z = sum(c * stat ** i for i, c in enumerate(SMALL if stat <= TAU[2] else LARGE))
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def design(x, lags):
    dx = np.diff(x)
    nobs = len(dx) - lags
    cols = [np.ones(nobs), x[-nobs - 1:-1]] + [dx[lags - j:len(dx) - j] for j in range(1, lags + 1)]
    return dx[-nobs:], np.column_stack(cols), nobs


def adf(values):
    """(statistic, p-value, lags, observations)."""
    x = np.asarray(values, float)
    most = max(min(len(x) // 2 - 2, int(math.ceil(12.0 * (len(x) / 100.0) ** 0.25))), 0)
    y, z, nobs = design(x, most)
    aics = []
    for p in range(most + 1):
        beta = np.linalg.lstsq(z[:, :p + 2], y, rcond=None)[0]
        ssr = float(((y - z[:, :p + 2] @ beta) ** 2).sum())
        aics.append(nobs * (math.log(2 * math.pi) + math.log(ssr / nobs) + 1) + 2 * (p + 2))
    p = int(np.argmin(aics))
    y, z, nobs = design(x, p)
    beta = np.linalg.lstsq(z, y, rcond=None)[0]
    ssr = float(((y - z @ beta) ** 2).sum())
    stat = beta[1] / math.sqrt(ssr / (nobs - z.shape[1]) * np.linalg.inv(z.T @ z)[1, 1])
    return float(stat), pvalue(stat), p, nobs


def durbin_levinson(rho):
    """Partial autocorrelations by solving the Yule-Walker equations of each order."""
    out = [1.0]
    for k in range(1, len(rho)):
        r = np.array([[rho[abs(i - j)] for j in range(k)] for i in range(k)])
        out.append(float(np.linalg.solve(r, np.array(rho[1:k + 1]))[-1]))
    return out
