"""Special functions for p-values and critical values.

Applied only to per-feature result rows (a handful per feature), through
Arrow-batched pandas UDFs.  Pure Python/NumPy implementations of the
regularised incomplete gamma / beta functions (series + Lentz continued
fraction) -- no SciPy in the runtime.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _gser(a, x):
    s = term = 1.0 / a
    ap = a
    for _ in range(1000):
        ap += 1
        term *= x / ap
        s += term
        if abs(term) < abs(s) * 1e-15:
            break
    return s * math.exp(-x + a * math.log(x) - math.lgamma(a))


def _gcf(a, x):
    tiny = 1e-300
    b = x + 1 - a
    c = 1 / tiny
    d = 1 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1 / d
        de = d * c
        h *= de
        if abs(de - 1) < 1e-15:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def gammainc_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    return 1.0 - _gser(a, x) if x < a + 1 else _gcf(a, x)


def chi2_sf(x: float, dof: float) -> float:
    if x is None or dof is None or dof <= 0 or (isinstance(x, float) and math.isnan(x)):
        return float("nan")
    return gammainc_upper(dof / 2.0, x / 2.0)


def _betacf(a, b, x):
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1, a - 1
    c, d = 1.0, 1 - qab * x / qap
    d = tiny if abs(d) < tiny else d
    d = 1 / d
    h = d
    for m in range(1, 1000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1 + aa * d
        d = tiny if abs(d) < tiny else d
        c = 1 + aa / c
        c = tiny if abs(c) < tiny else c
        d = 1 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1 + aa * d
        d = tiny if abs(d) < tiny else d
        c = 1 + aa / c
        c = tiny if abs(c) < tiny else c
        d = 1 / d
        de = d * c
        h *= de
        if abs(de - 1) < 1e-15:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1 - math.exp(lbt) * _betacf(b, a, 1 - x) / b


def f_sf(f: float, d1: float, d2: float) -> float:
    if f is None or not f == f or f <= 0:
        return 1.0 if f is not None and f == f else float("nan")
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def t_cdf(t: float, dof: float) -> float:
    x = dof / (dof + t * t)
    p = 0.5 * betainc(dof / 2.0, 0.5, x)
    return 1 - p if t > 0 else p


def t_quantile(p: float, dof: float) -> float:
    if dof is None or not dof > 0:
        return float("nan")
    lo, hi = -1e3, 1e3
    for _ in range(200):
        mid = (lo + hi) / 2
        if t_cdf(mid, dof) < p:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2


def normal_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2))


#: Fixed values (MacKinnon 1994, one series, constant): coefficients of the polynomials whose normal CDF is the p-value of
#: a Dickey-Fuller statistic, under and above the turning point, and the range where they hold.
ADF_SMALL = (2.1659, 1.4412, 0.038269)
ADF_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
ADF_TURN, ADF_LOW, ADF_HIGH = -1.61, -18.83, 2.74
#: Fixed values (MacKinnon 2010, one series, constant): 1, 5 and 10 % critical values by powers of 1 / rows.
ADF_CRITICAL = ((-3.43035, -6.5393, -16.786, -79.433), (-2.86154, -2.8903, -4.234, -40.040), (-2.56677, -1.5384, -2.809, 0.0))


def adf_p_value(stat: float) -> float:
    if stat > ADF_HIGH:
        return 1.0
    if stat < ADF_LOW:
        return 0.0
    part = ADF_SMALL if stat <= ADF_TURN else ADF_LARGE
    return normal_cdf(sum(c * stat ** i for i, c in enumerate(part)))


def adf_critical_values(rows: int) -> list[float]:
    return [sum(c / rows ** i for i, c in enumerate(level)) for level in ADF_CRITICAL]


def kolmogorov_sf(d: float, n1: float, n2: float) -> float:
    """Asymptotic two-sample KS p-value."""
    en = math.sqrt(n1 * n2 / (n1 + n2))
    lam = (en + 0.12 + 0.11 / en) * d
    if lam < 1e-3:
        return 1.0
    s = sum(2 * (-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
    return min(max(s, 0.0), 1.0)


def kolmogorov_sf_one(d: float, n: float) -> float:
    """Asymptotic one-sample KS p-value."""
    return kolmogorov_sf(d, 2 * n, 2 * n)


def _vec(fn):
    def run(*cols: pd.Series) -> pd.Series:
        arr = [c.to_numpy(dtype=float) for c in cols]
        return pd.Series([fn(*vals) for vals in zip(*arr)], dtype="float64")
    return run


chi2_sf_udf = F.pandas_udf(_vec(chi2_sf), DoubleType())
f_sf_udf = F.pandas_udf(_vec(f_sf), DoubleType())
t_quantile_udf = F.pandas_udf(_vec(t_quantile), DoubleType())
ks_one_pvalue_udf = F.pandas_udf(_vec(kolmogorov_sf_one), DoubleType())
ks_pvalue_udf = F.pandas_udf(_vec(kolmogorov_sf), DoubleType())
_STEP, _REACH = 0.005, 37.0
_LOG_CDF: list[np.ndarray] = []


def normal_cdf_array(x: np.ndarray) -> np.ndarray:
    """Standard normal CDF of an array: cubic Hermite interpolation of its logarithm on a fine grid (made once per
    process), so the lower tail keeps its relative accuracy."""
    if not _LOG_CDF:
        grid = np.arange(-_REACH, _REACH + 2 * _STEP, _STEP)
        value = np.array([math.log(normal_cdf(z)) for z in grid])
        _LOG_CDF[:] = [value, np.exp(-grid * grid / 2 - value) / math.sqrt(2 * math.pi)]
    value, slope = _LOG_CDF
    z = np.clip(np.asarray(x, dtype=float), -_REACH, _REACH)
    at = np.where(np.isnan(z), 0.0, (z + _REACH) / _STEP)
    i = np.minimum(at.astype(int), len(value) - 2)
    t = at - i
    a, b, da, db = value[i], value[i + 1], slope[i] * _STEP, slope[i + 1] * _STEP
    out = np.exp(a + t * (da + t * (3 * (b - a) - 2 * da - db + t * (2 * (a - b) + da + db))))
    return np.where(np.isnan(z), np.nan, np.minimum(out, 1.0))


# ------------------------------------------------------------ arrays
def digamma_array(x: np.ndarray) -> np.ndarray:
    """Digamma of positive numbers: asymptotic series twelve places up, recurrence down."""
    x = np.asarray(x, dtype=float)
    y = x + 12
    z = 1 / (y * y)
    out = np.log(y) - 0.5 / y - z * (1 / 12 - z * (1 / 120 - z * (1 / 252 - z * (1 / 240 - z / 132))))
    return out - sum(1 / (x + j) for j in range(12))


def trigamma_array(x: np.ndarray) -> np.ndarray:
    """Derivative of digamma for positive numbers."""
    x = np.asarray(x, dtype=float)
    y = x + 12
    z = 1 / (y * y)
    out = 1 / y + z / 2 + z / y * (1 / 6 - z * (1 / 30 - z * (1 / 42 - z * (1 / 30 - z * 5 / 66))))
    return out + sum(1 / (x + j) ** 2 for j in range(12))


def lgamma_array(x: np.ndarray) -> np.ndarray:
    """Logarithm of gamma for positive numbers."""
    x = np.asarray(x, dtype=float)
    y = x + 12
    z = 1 / (y * y)
    out = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z / 1188)))) / y
    return out - np.log(np.multiply.reduce([x + j for j in range(12)]))


def _continued(first: np.ndarray, term, most: int = 2000) -> np.ndarray:
    """Value of a continued fraction ``first / (1 + ...)`` by Lentz's method on arrays; ``term(i)`` gives the i-th numerator
    and denominator."""
    tiny = 1e-300
    h, c, d = first.copy(), first.copy(), np.zeros_like(first)
    h[h == 0] = tiny
    c = h.copy()
    for i in range(1, most):
        a, b = term(i)
        d = b + a * d
        d[np.abs(d) < tiny] = tiny
        c = b + a / c
        c[np.abs(c) < tiny] = tiny
        d = 1 / d
        h = h * c * d
        if np.all(np.abs(c * d - 1) < 1e-15):
            break
    return h


def gamma_cdf_array(x: np.ndarray, shape: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """CDF of the gamma distribution (regularised lower incomplete gamma): series under ``shape + 1``, continued fraction
    above; NaN for parameters that aren't positive."""
    x, a, s = np.broadcast_arrays(*[np.asarray(v, dtype=float) for v in (x, shape, scale)])
    out = np.where((a > 0) & (s > 0), 0.0, np.nan)
    todo = np.flatnonzero((a > 0) & (s > 0) & (x > 0))
    z, a = x[todo] / s[todo], a[todo]
    front = np.exp(a * np.log(z) - z - lgamma_array(a))
    low = z < a + 1
    value = np.empty(len(z))
    t, b = z[low], a[low]
    term = total = 1 / b if len(b) else b
    for i in range(1, 5000):
        term = term * t / (b + i)
        total = total + term
        if not len(t) or np.all(term < total * 1e-16):
            break
    value[low] = front[low] * total
    t, b = z[~low], a[~low]
    if len(t):
        start = t + 1 - b
        fraction = _continued(start, lambda i: (-i * (i - b), start + 2 * i))
        value[~low] = 1 - front[~low] / fraction
    out[todo] = np.clip(value, 0, 1)
    return out


def beta_cdf_array(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """CDF of the beta distribution on [0, 1]; NaN for parameters that aren't positive."""
    x, a, b = np.broadcast_arrays(*[np.asarray(v, dtype=float) for v in (x, a, b)])
    good = (a > 0) & (b > 0)
    out = np.where(good, np.where(x >= 1, 1.0, 0.0), np.nan)
    todo = np.flatnonzero(good & (x > 0) & (x < 1))
    z, p, q = x[todo], a[todo], b[todo]
    turn = z > (p + 1) / (p + q + 2)  # the fraction converges fast on the other side
    z, p, q = np.where(turn, 1 - z, z), np.where(turn, q, p), np.where(turn, p, q)
    front = np.exp(p * np.log(z) + q * np.log1p(-z) + lgamma_array(p + q) - lgamma_array(p) - lgamma_array(q)) / p

    def term(i):
        m = i // 2
        if i % 2:
            return -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1)), np.ones_like(z)
        return m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)), np.ones_like(z)
    value = front / _continued(np.ones_like(z), term) if len(z) else z
    out[todo] = np.clip(np.where(turn, 1 - value, value), 0, 1)
    return out


gamma_cdf_udf = F.pandas_udf(lambda x, a, s: pd.Series(gamma_cdf_array(x.to_numpy(float), a.to_numpy(float), s.to_numpy(float))), DoubleType())
beta_cdf_udf = F.pandas_udf(lambda x, a, b: pd.Series(beta_cdf_array(x.to_numpy(float), a.to_numpy(float), b.to_numpy(float))), DoubleType())

normal_cdf_udf = F.pandas_udf(lambda s: pd.Series(normal_cdf_array(s.to_numpy(dtype=float))), DoubleType())


def normal_ppf(p: np.ndarray | float):
    """Acklam's rational approximation refined by one Newton step."""
    p = np.asarray(p, dtype=float)
    # Coefficients of the published rational approximation.
    a = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02,
         -3.066479806614716e+01, 2.506628277459239e+00]
    b = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01,
         -1.328068155288572e+01]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00,
         4.374664141464968e+00, 2.938163982698783e+00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00]
    q = np.where(p < 0.5, p, 1 - p)
    r = np.sqrt(-2 * np.log(np.clip(q, 1e-300, None)))
    tail = (((((c[0] * r + c[1]) * r + c[2]) * r + c[3]) * r + c[4]) * r + c[5]) / \
        ((((d[0] * r + d[1]) * r + d[2]) * r + d[3]) * r + 1)
    u = p - 0.5
    s = u * u
    mid = (((((a[0] * s + a[1]) * s + a[2]) * s + a[3]) * s + a[4]) * s + a[5]) * u / \
        (((((b[0] * s + b[1]) * s + b[2]) * s + b[3]) * s + b[4]) * s + 1)
    x = np.where(np.abs(u) <= 0.5 - 0.02425, mid, np.where(p < 0.5, tail, -tail))
    from math import erfc, exp, pi, sqrt
    e = np.vectorize(lambda v, pp: 0.5 * erfc(-v / sqrt(2)) - pp)(x, p)
    return x - e * np.sqrt(2 * pi) * np.exp(x * x / 2)


normal_ppf_udf = F.pandas_udf(lambda s: pd.Series(normal_ppf(s.to_numpy(dtype=float))), DoubleType())
