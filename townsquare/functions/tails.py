"""Tail probabilities of the tests' statistics: scalar maths on a handful of doubles (driver side)."""

from __future__ import annotations

import math

import numpy as np
from statistics import NormalDist

_TINY = 1e-300
_EPS = 1e-15
_MAX_STEPS = 1_000_000


#: Values of U up to which its distribution is built cell by cell.
MAX_CELLS = 20_000_000


def regularised_beta(a: float, b: float, x: float) -> float:
    """I_x(a, b), by the usual continued fraction."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - regularised_beta(b, a, 1 - x)
    front = a * math.log(x) + b * math.log1p(-x) - math.log(a) - _log_beta(a, b)
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > _TINY else _TINY)
    value = d
    for m in range(1, _MAX_STEPS):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > _TINY else _TINY)
            c = 1.0 + numerator / c
            c = c if abs(c) > _TINY else _TINY
            value *= c * d
        if abs(c * d - 1.0) < _EPS:
            break
    return math.exp(front) * value


def _log_beta(a: float, b: float) -> float:
    return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)


def f_tail(f: float, df1: float, df2: float) -> float:
    """P(F > f)."""
    if math.isinf(f):
        return 0.0
    return regularised_beta(df2 / 2, df1 / 2, df2 / (df2 + df1 * f)) if f > 0 else 1.0


def t_two_sided(t: float, df: float) -> float:
    """P(|T| > |t|)."""
    return regularised_beta(df / 2, 0.5, df / (df + t * t))


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def chi2_tail(x: float, df: int) -> float:
    """P(χ² > x) for whole degrees of freedom, by the recurrence on df from its closed forms."""
    if x <= 0:
        return 1.0
    half = x / 2
    tail = math.erfc(math.sqrt(half)) if df % 2 else math.exp(-half)
    for k in range(3 if df % 2 else 4, df + 1, 2):
        tail += math.exp((k / 2 - 1) * math.log(half) - half - math.lgamma(k / 2))
    return min(1.0, tail)


def correlation_p(r: float | None, n: int) -> float | None:
    """Two-sided p of a product-moment (or rank) correlation over n pairs."""
    if r is None or math.isnan(r) or n < 2:
        return None
    if n == 2:
        return 1.0
    return regularised_beta((n - 2) / 2, 0.5, max(0.0, 1 - r * r))


def mann_whitney_p(u1: float, n1: int, n2: int, tie_term: float) -> float:
    """Two-sided p of U: exact for a tie-free sample with a small group, else normal with tie correction."""
    if tie_term == 0 and 0 < min(n1, n2) <= 8:
        return _mann_whitney_exact(max(u1, n1 * n2 - u1), n1, n2)
    n = n1 + n2
    variance = n1 * n2 / 12 * ((n + 1) - tie_term / (n * (n - 1)))
    if variance <= 0:
        return 1.0
    z = (max(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5) / math.sqrt(variance)
    return min(1.0, math.erfc(z / math.sqrt(2)))


def _mann_whitney_exact(u: float, n1: int, n2: int) -> float:
    """P of a U at least ``u`` on either side, without ties.

    The smaller group's members fall between those of the larger one, and the counts of U are
    the coefficients of a Gaussian binomial, built as shares so that they stay below one. Where
    U can take more than MAX_CELLS values, the larger group's gaps are as good as continuous
    and U is a sum of uniform variables, with an error of the order of small / large.
    """
    small, large = sorted((n1, n2))
    cells = n1 * n2 + 1
    if cells > MAX_CELLS:
        x = small - (u - 0.5) / large
        terms = ((-1) ** k * math.comb(small, k) * max(0.0, x - k) ** small for k in range(small + 1))
        return min(1.0, 2 * max(0.0, sum(terms)) / math.factorial(small))
    shares = np.zeros(cells)
    shares[0] = 1.0
    for i in range(1, small + 1):
        # Times (1 - x^(large + i)), divided by (1 - x^i); i / (large + i) keeps the total at one.
        moved = shares.copy()
        if large + i < cells:
            moved[large + i :] -= shares[: cells - large - i]
        padded = np.concatenate([moved, np.zeros(-cells % i)]).reshape(-1, i)
        shares = np.cumsum(padded, axis=0).ravel()[:cells] * (i / (large + i))
    return min(1.0, max(0.0, 2 * float(shares[math.ceil(u) :].sum())))


def kendall_p(
    concordant: int,
    discordant: int,
    n: int,
    x_ties: tuple[int, int, int],
    y_ties: tuple[int, int, int],
) -> float | None:
    """Two-sided p of Kendall's tau.

    The tie triples hold Σt(t-1)/2, Σt(t-1)(t-2) and Σt(t-1)(2t+5) over groups of equal values.
    Without ties and with few pairs the permutation distribution is used, else the normal one.
    """
    if n < 2:
        return None
    pairs = n * (n - 1) // 2
    if x_ties[0] == pairs or y_ties[0] == pairs:
        return None
    fewest = min(discordant, pairs - discordant)
    if x_ties[0] == 0 and y_ties[0] == 0 and (n <= 33 or fewest <= 1):
        return _kendall_exact(n, fewest)
    m = n * (n - 1)
    variance = (m * (2 * n + 5) - x_ties[2] - y_ties[2]) / 18 + 2 * x_ties[0] * y_ties[0] / m
    if n > 2:
        variance += x_ties[1] * y_ties[1] / (9 * m * (n - 2))
    return normal_two_sided((concordant - discordant) / math.sqrt(variance)) if variance > 0 else None


def _kendall_exact(n: int, inversions: int) -> float:
    if n == 2:
        return 1.0
    if inversions == 0:
        return 2.0 / math.factorial(n) if n < 171 else 0.0
    if inversions == 1:
        return 2.0 / math.factorial(n - 1) if n < 172 else 0.0
    if 4 * inversions == n * (n - 1):
        return 1.0
    counts = [1] + [0] * inversions
    for size in range(2, n + 1):
        running, previous = 0, counts
        counts = []
        for k in range(inversions + 1):
            running += previous[k] - (previous[k - size] if k >= size else 0)
            counts.append(running)
    return min(1.0, 2 * sum(counts) / math.factorial(n))


def _poly(coefficients: tuple[float, ...], x: float) -> float:
    return sum(c * x**k for k, c in enumerate(coefficients))


def skew_kurtosis_z(n: int, skewness: float, excess: float) -> tuple[float, float]:
    """Normal scores of sample skewness and (excess) kurtosis: D'Agostino 1970, Anscombe-Glynn 1983."""
    y = skewness * math.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = math.sqrt(2 * (beta2 - 1)) - 1
    z_skew = math.asinh(y / math.sqrt(2 / (w2 - 1))) / math.sqrt(0.5 * math.log(w2))

    expected = 3 * (n - 1) / (n + 1)
    variance = 24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))
    x = (excess + 3 - expected) / math.sqrt(variance)
    shape = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * math.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / shape * (2 / shape + math.sqrt(1 + 4 / shape**2))
    ratio = (1 - 2 / a) / (1 + x * math.sqrt(2 / (a - 4)))
    root = math.copysign(abs(ratio) ** (1 / 3), ratio)
    z_kurt = (1 - 2 / (9 * a) - root) / math.sqrt(2 / (9 * a))
    return z_skew, z_kurt


def normal_scores(n: int) -> list[float]:
    """Blom's approximate normal order scores."""
    inverse = NormalDist().inv_cdf
    return [inverse((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)]


def shapiro_weights(n: int) -> list[float]:
    """Royston's (1995) weights of the ordered sample."""
    if n == 3:
        return [-math.sqrt(0.5), 0.0, math.sqrt(0.5)]
    m = normal_scores(n)
    total = sum(v * v for v in m)
    u = 1 / math.sqrt(n)
    last = m[-1] / math.sqrt(total) + _poly((0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056), u)
    if n <= 5:
        phi = (total - 2 * m[-1] ** 2) / (1 - 2 * last**2)
        edge = [last]
    else:
        second = m[-2] / math.sqrt(total) + _poly((0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633), u)
        phi = (total - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * last**2 - 2 * second**2)
        edge = [second, last]
    k = len(edge)
    middle = [v / math.sqrt(phi) for v in m[k : n - k]]
    return [-v for v in reversed(edge)] + middle + edge


def shapiro_p(w: float, n: int) -> float:
    """p of the Shapiro-Wilk statistic, Royston (1995)."""
    if n == 3:
        p = 6 / math.pi * (math.asin(math.sqrt(min(1.0, w))) - math.asin(math.sqrt(0.75)))
        return min(1.0, max(0.0, p))
    if w >= 1:
        return 1.0
    y = math.log(1 - w)
    if n <= 11:
        gamma = -2.273 + 0.459 * n
        if y >= gamma:
            return 1e-99
        y = -math.log(gamma - y)
        mean = _poly((0.544, -0.39978, 0.025054, -6.714e-4), n)
        deviation = math.exp(_poly((1.3822, -0.77857, 0.062767, -0.0020322), n))
    else:
        log_n = math.log(n)
        mean = _poly((-1.5861, -0.31082, -0.083751, 0.0038915), log_n)
        deviation = math.exp(_poly((-0.4803, -0.082676, 0.0030302), log_n))
    return 0.5 * math.erfc((y - mean) / deviation / math.sqrt(2))


def unit_root_p(t: float) -> float:
    """p of the Dickey-Fuller t with a constant, MacKinnon (1994)."""
    if t > 2.74:
        return 1.0
    if t < -18.83:
        return 0.0
    small, large = (2.1659, 1.4412, 0.038269), (1.7339, 0.93202, -0.12745, -0.010368)
    return NormalDist().cdf(_poly(small if t <= -1.61 else large, t))
