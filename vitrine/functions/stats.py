"""Distribution tails in pure Python (no scipy at runtime): regularized
incomplete beta by continued fraction, Student t, F, normal, and exact
small-sample rank-test distributions. Used only on small result frames."""

from __future__ import annotations

import math
from functools import lru_cache


def _betacf(a: float, b: float, x: float) -> float:
    tiny, eps = 1e-300, 3e-16
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1.0) < eps:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1 - x) / b


def t_sf_two_sided(t: float, df: float) -> float:
    if t is None or df is None or df <= 0 or math.isnan(t):
        return float("nan")
    if math.isinf(t):
        return 0.0
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def t_ppf(p: float, df: float) -> float:
    """Quantile of Student t (bisection on the two-sided tail)."""
    if p == 0.5:
        return 0.0
    target = 2 * (1 - p) if p > 0.5 else 2 * p
    lo, hi = 0.0, 1e6
    for _ in range(80):  # 1e6 / 2**80 < 1e-18
        mid = (lo + hi) / 2
        if t_sf_two_sided(mid, df) > target:
            lo = mid
        else:
            hi = mid
    q = (lo + hi) / 2
    return q if p > 0.5 else -q


def f_sf(f: float, d1: float, d2: float) -> float:
    if f is None or math.isnan(f) or f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def norm_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


@lru_cache(maxsize=None)
def _signed_rank_counts(n: int) -> tuple:
    """Number of sign assignments giving each rank sum W+ for ranks 1..n."""
    counts = [1]
    for r in range(1, n + 1):
        nxt = [0] * (len(counts) + r)
        for s, c in enumerate(counts):
            nxt[s] += c
            nxt[s + r] += c
        counts = nxt
    return tuple(counts)


def wilcoxon_p(w_stat: float, n: int) -> float:
    """Two-sided exact p of the signed-rank statistic min(W+, W-) for n <= 25
    (integer ranks); normal approximation above."""
    if n == 0:
        return float("nan")
    if n <= 25 and float(w_stat).is_integer():
        counts = _signed_rank_counts(n)
        total = 2 ** n
        p = sum(counts[: int(w_stat) + 1]) / total
        return min(1.0, 2 * p)
    mu, sd = n * (n + 1) / 4, math.sqrt(n * (n + 1) * (2 * n + 1) / 24)
    return min(1.0, 2 * norm_sf(abs(w_stat - mu) / sd))


@lru_cache(maxsize=None)
def _mw_counts(n1: int, n2: int) -> tuple:
    """Distribution of the U statistic (no ties) by dynamic programming."""
    dp = [[[0] * (n1 * n2 + 1) for _ in range(n2 + 1)] for _ in range(n1 + 1)]
    for i in range(n1 + 1):
        for j in range(n2 + 1):
            if i == 0 or j == 0:
                dp[i][j][0] = 1
                continue
            for u in range(n1 * n2 + 1):
                a = dp[i - 1][j][u - j] if u - j >= 0 else 0
                dp[i][j][u] = a + dp[i][j - 1][u]
    return tuple(dp[n1][n2])


def mann_whitney_p(u_stat: float, n1: int, n2: int) -> float:
    """Two-sided p of U = min(U1, U2): exact for small samples, else normal."""
    if n1 == 0 or n2 == 0:
        return float("nan")
    if n1 * n2 <= 400 and float(u_stat).is_integer():
        counts = _mw_counts(n1, n2)
        total = sum(counts)
        return min(1.0, 2 * sum(counts[: int(u_stat) + 1]) / total)
    mu, sd = n1 * n2 / 2, math.sqrt(n1 * n2 * (n1 + n2 + 1) / 12)
    return min(1.0, 2 * norm_sf(abs(u_stat - mu) / sd))


def t_table(max_df: int = 200, p: float = 0.975) -> list:
    """(df, t quantile) rows for df 1..max_df."""
    return [(d, t_ppf(p, d)) for d in range(1, max_df + 1)]


def t_tail(z: float = 1.959963984540054) -> list:
    """Coefficients of 1 / df ** i, i = 0..4, of the t quantile whose normal quantile is ``z``."""
    return [z, (z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96, (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
            (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160]
