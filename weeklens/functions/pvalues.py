"""Driver-side p-values for a handful of test rows (one per column).

Only (statistic, sizes, dof) reach the driver; these are scalar series.
KS: exact distribution (lattice paths) when both samples hold at most
10,000 values, as the public scipy routine does by default; above that the
asymptotic Kolmogorov distribution with Stephens' correction (the public
routine uses the one-sample distribution at n1 n2 / (n1 + n2) there; the two
agree to a few units in the last digits at those sizes).
"""

from __future__ import annotations

import math


def kolmogorov_sf(lam: float) -> float:
    """P(K > lam) for the Kolmogorov distribution."""
    if lam <= 0:
        return 1.0
    if lam < 0.2:
        return 1.0
    total = 0.0
    for k in range(1, 201):
        term = math.exp(-2.0 * k * k * lam * lam)
        total += term if k % 2 else -term
        if term < 1e-16:
            break
    return max(0.0, min(1.0, 2.0 * total))


EXACT_MAX_N = 10_000


def ks_exact_sf(d: float, m: int, n: int) -> float:
    """P(D >= d) for the two-sample statistic of samples of sizes m and n
    (continuous data): one minus the share of the C(m+n, m) monotone lattice
    paths from (0,0) to (m,n) that stay strictly inside |i/m - j/n| < d.
    Row by row, the inside cells of a row form one interval and a cell's
    count is the prefix sum of the previous row over that interval; rows are
    rescaled to avoid overflow."""
    import numpy as np
    g = math.gcd(m, n)
    lcm = m // g * n
    k = round(d * lcm)             # d is a multiple of 1 / lcm
    if k <= 0:
        return 1.0
    bound = k * g                  # inside  <=>  |i n - j m| < bound
    j = np.arange(n + 1)
    row = np.cumprod(j * m < bound).astype(float)
    log_scale = 0.0
    for i in range(1, m + 1):
        lo = max(0, (i * n - bound) // m + 1)
        hi = min(n, (i * n + bound - 1) // m)
        new = np.zeros(n + 1)
        if lo <= hi:
            new[lo:hi + 1] = np.cumsum(row[lo:hi + 1])
        top = new.max()
        if top <= 0:
            return 1.0
        row = new / top
        log_scale += math.log(top)
    if row[n] <= 0:
        return 1.0
    log_inside = math.log(row[n]) + log_scale
    log_total = math.lgamma(m + n + 1) - math.lgamma(m + 1) - math.lgamma(n + 1)
    return max(0.0, min(1.0, 1.0 - math.exp(log_inside - log_total)))


def ks_pvalue(d: float, n1: float, n2: float) -> float:
    if n1 <= 0 or n2 <= 0:
        return float("nan")
    if max(n1, n2) <= EXACT_MAX_N and float(n1).is_integer() and float(n2).is_integer():
        return ks_exact_sf(d, int(n1), int(n2))
    en = n1 * n2 / (n1 + n2)
    s = math.sqrt(en)
    return kolmogorov_sf((s + 0.12 + 0.11 / s) * d)


def _gamma_series(a: float, x: float) -> float:
    # regularized lower incomplete gamma P(a, x), series form (x < a + 1)
    term = 1.0 / a
    total = term
    ap = a
    for _ in range(10_000):
        ap += 1.0
        term *= x / ap
        total += term
        if abs(term) < abs(total) * 1e-15:
            break
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def _gamma_cf(a: float, x: float) -> float:
    # regularized upper incomplete gamma Q(a, x), continued fraction (x >= a + 1)
    tiny = 1e-300
    b = x + 1.0 - a
    c = 1.0 / tiny
    d = 1.0 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def chi2_sf(x: float, dof: float) -> float:
    """P(X > x) for a chi-square variable with ``dof`` degrees of freedom."""
    if dof <= 0:
        return float("nan")
    if x <= 0:
        return 1.0
    a, h = dof / 2.0, x / 2.0
    if h < a + 1.0:
        return max(0.0, 1.0 - _gamma_series(a, h))
    return min(1.0, _gamma_cf(a, h))
