"""p-values without scipy: special functions in numpy, as Arrow-batched UDFs."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_erfc = np.vectorize(math.erfc, otypes=[float])
_lgamma = np.vectorize(lambda x: math.lgamma(x) if x > 0 else math.nan, otypes=[float])


def _gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if not (a > 0 and x >= 0):
        return math.nan
    if x == 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        for _ in range(10_000):
            n += 1
            term *= x / n
            total += term
            if abs(term) < abs(total) * 1e-16:
                break
        return max(0.0, 1 - total * scale)
    b, c, d = x + 1 - a, 1e300, 1 / (x + 1 - a)
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1 / ((an * d + b) or 1e-300)
        c = (b + an / c) or 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return scale * h


def _beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function, by a continued fraction."""
    if not (a > 0 and b > 0 and 0 <= x <= 1):
        return math.nan
    if x in (0.0, 1.0):
        return float(x)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1 / ((1 - (a + b) * x / (a + 1)) or 1e-300)
    h = d
    for m in range(1, 10_000):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / ((1 + num * d) or 1e-300)
            c = (1 + num / c) or 1e-300
            h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return front * h


def chi2_sf(x: float, df: float) -> float:
    """1 for x below 0 too: a statistic of 0 may be a little less by rounding."""
    return _gamma_upper(df / 2, max(x, 0.0) / 2)


#: Below this, closed forms that take something from 1 lose digits, and the continued fraction is used.
CLOSED = 1e-6


def _t_closed(th: float, df: float) -> float:
    """Two-sided p of Student's t in closed form up to six degrees of freedom, th = atan(|t| / sqrt(df)); nan beyond."""
    s, c = math.sin(th), math.cos(th)
    if df == 1:
        return 1 - 2 * th / math.pi
    if df == 2:
        return 1 - s
    if df == 3:
        return 1 - 2 / math.pi * (th + s * c)
    if df == 4:
        return 1 - s * (1 + c**2 / 2)
    if df == 5:
        return 1 - 2 / math.pi * (th + s * (c + 2 / 3 * c**3))
    if df == 6:
        return 1 - s * (1 + c**2 / 2 + 3 / 8 * c**4)
    return math.nan


def t_two_sided(t: float, df: float) -> float:
    if math.isnan(t) or not df > 0:
        return math.nan
    if math.isinf(t):
        return 0.0
    p = _t_closed(math.atan(abs(t) / math.sqrt(df)), df)
    return p if p >= CLOSED else _beta(df / 2, 0.5, df / (df + t * t))


def f_sf(f: float, d1: float, d2: float) -> float:
    """1 for f below 0 too: a statistic of 0 may be a little less by rounding."""
    if math.isnan(f):
        return math.nan
    f = max(f, 0.0)
    if math.isinf(f):
        return 0.0
    if d1 == 2 and d2 > 0:
        return (1 + 2 * f / d2) ** (-d2 / 2)
    p = _t_closed(math.atan(math.sqrt(f / d2)), d2) if d1 == 1 and d2 > 0 else math.nan
    return p if p >= CLOSED else _beta(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))


def u_exact(u: float, n1: int, n2: int) -> float:
    """Two-sided p of Mann-Whitney's U without ties, from the count of arrangements."""
    big = max(u, n1 * n2 - u)
    ways = np.zeros(n1 * n2 + 1)
    ways[0] = 1.0
    for i in range(1, n1 + 1):  # Gaussian binomial coefficient
        new = ways.copy()
        for j in range(n2 + i, len(ways)):
            new[j] -= ways[j - n2 - i]
        ways = new
        for j in range(i, len(ways)):
            ways[j] += ways[j - i]
    return float(min(1.0, 2 * ways[math.ceil(big) :].sum() / ways.sum()))


def u_two_sided(u: float, n1: int, n2: int, ties: float) -> float:
    """Exact for small samples without ties, else normal with tie and continuity corrections. ties: sum of t^3 - t."""
    if math.isnan(u) or n1 < 1 or n2 < 1:
        return math.nan
    if ties == 0 and min(n1, n2) <= 8:
        return u_exact(u, n1, n2)
    n = n1 + n2
    var = n1 * n2 / 12 * ((n + 1) - ties / (n * (n - 1)))
    if var <= 0:
        return 1.0
    z = (max(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / math.sqrt(var)
    return min(1.0, math.erfc(z / math.sqrt(2)))


def _normal_quantile(p: float) -> float:
    """Inverse of the normal distribution, by bisection on erfc."""
    lo, hi = -40.0, 40.0
    for _ in range(200):
        mid = (lo + hi) / 2
        if 0.5 * math.erfc(-mid / math.sqrt(2)) < p:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2


def shapiro(values: list[float]) -> tuple[float, float]:
    """Shapiro and Wilk's W with Royston's p-value, for 3 to 5000 values."""
    x = np.sort(np.asarray(values, float))
    n = len(x)
    if n < 3 or x[0] == x[-1]:
        return math.nan, math.nan
    m = np.array([_normal_quantile((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    mm, u = float((m**2).sum()), 1 / math.sqrt(n)
    a = m / math.sqrt(mm)
    if n == 3:
        a = np.array([-math.sqrt(0.5), 0, math.sqrt(0.5)])
    else:
        last = np.polyval([-2.706056, 4.434685, -2.07119, -0.147981, 0.221157, a[-1]], u)
        if n > 5:
            second = np.polyval([-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, a[-2]], u)
            phi = (mm - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * last**2 - 2 * second**2)
            a = m / math.sqrt(phi)
            a[-2], a[1] = second, -second
        else:
            phi = (mm - 2 * m[-1] ** 2) / (1 - 2 * last**2)
            a = m / math.sqrt(phi)
        a[-1], a[0] = last, -last
    w = min(1.0, float((a @ x) ** 2 / ((x - x.mean()) ** 2).sum()))
    if n == 3:
        return w, max(0.0, 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    if w >= 1:
        return w, 1.0
    if n <= 11:
        g = -2.273 + 0.459 * n
        y = -math.log(max(1e-300, g - math.log(1 - w)))
        mean = 0.544 - 0.39978 * n + 0.025054 * n**2 - 0.0006714 * n**3
        sd = math.exp(1.3822 - 0.77857 * n + 0.062767 * n**2 - 0.0020322 * n**3)
    else:
        y, ln = math.log(1 - w), math.log(n)
        mean = -1.5861 - 0.31082 * ln - 0.083751 * ln**2 + 0.0038915 * ln**3
        sd = math.exp(-0.4803 - 0.082676 * ln + 0.0030302 * ln**2)
    return w, 0.5 * math.erfc((y - mean) / sd / math.sqrt(2))


def _each(f, *series: pd.Series) -> pd.Series:
    def one(*x):
        if any(v is None or (isinstance(v, float) and math.isnan(v)) for v in x):
            return None
        p = f(*x)
        return None if math.isnan(p) else p

    return pd.Series([one(*x) for x in zip(*series, strict=True)], dtype="Float64")


@F.pandas_udf(DoubleType())
def chi2_p(x: pd.Series, df: pd.Series) -> pd.Series:
    return _each(chi2_sf, x, df)


@F.pandas_udf(DoubleType())
def t_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return _each(t_two_sided, t, df)


@F.pandas_udf(DoubleType())
def f_p(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _each(f_sf, f, d1, d2)


@F.pandas_udf(DoubleType())
def u_p(u: pd.Series, n1: pd.Series, n2: pd.Series, ties: pd.Series) -> pd.Series:
    return _each(lambda a, b, c, d: u_two_sided(a, int(b), int(c), d), u, n1, n2, ties)


@F.pandas_udf(DoubleType())
def shapiro_p(values: pd.Series) -> pd.Series:
    def one(v):
        if v is None or len(v) < 3:
            return None
        p = shapiro([float(x) for x in v])[1]
        return None if math.isnan(p) else p

    return pd.Series([one(v) for v in values], dtype="Float64")
