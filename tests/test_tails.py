"""p-values against published or closed-form values."""

import itertools
import math
from statistics import NormalDist

import pytest

from townsquare.functions import tails


def test_beta_f_t():
    assert tails.regularised_beta(2, 3, 0.4) == pytest.approx(0.5248)
    # Cauchy: P(|T1| > 1) = 1/2; F(1, d) = T(d)².
    assert tails.t_two_sided(1.0, 1) == pytest.approx(0.5)
    assert tails.f_tail(2.5**2, 1, 7) == pytest.approx(tails.t_two_sided(2.5, 7))
    # Table values.
    assert tails.t_two_sided(2.228, 10) == pytest.approx(0.05, abs=1e-4)
    assert tails.f_tail(3.4780, 4, 10) == pytest.approx(0.05, abs=1e-4)
    assert 0 <= tails.correlation_p(0.001, 10**9) < 1e-200


def test_chi2():
    assert tails.chi2_tail(5.991, 2) == pytest.approx(0.05, abs=1e-4)
    assert tails.chi2_tail(3.841, 1) == pytest.approx(0.05, abs=1e-4)
    assert tails.chi2_tail(9.488, 4) == pytest.approx(0.05, abs=1e-4)
    assert tails.chi2_tail(11.070, 5) == pytest.approx(0.05, abs=1e-4)


def test_shapiro_published():
    sample = sorted([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236])
    mean = sum(sample) / len(sample)
    w = sum(a * x for a, x in zip(tails.shapiro_weights(11), sample)) ** 2 / sum((x - mean) ** 2 for x in sample)
    assert w == pytest.approx(0.78881, abs=1e-5)
    assert tails.shapiro_p(w, 11) == pytest.approx(0.00670, abs=1e-5)


def test_skew_kurtosis_worked_values():
    def shape(xs):
        n, mu = len(xs), sum(xs) / len(xs)
        m2, m3, m4 = (sum((x - mu) ** k for x in xs) / n for k in (2, 3, 4))
        return n, m3 / m2**1.5, m4 / m2**2 - 3

    assert tails.skew_kurtosis_z(*shape([2, 8, 0, 4, 1, 9, 9, 0]))[0] == pytest.approx(0.446264, abs=1e-6)
    assert tails.skew_kurtosis_z(*shape(list(range(20))))[1] == pytest.approx(-1.705810, abs=1e-6)


def test_unit_root():
    assert tails.unit_root_p(-2.86) == pytest.approx(0.0502, abs=1e-4)
    assert tails.unit_root_p(-3.43) == pytest.approx(0.00998, abs=1e-4)
    assert tails.unit_root_p(3) == 1.0 and tails.unit_root_p(-20) == 0.0


def test_mann_whitney_exact_by_enumeration():
    n1, n2 = 3, 4
    us = [sum(c) - n1 * (n1 + 1) / 2 for c in itertools.combinations(range(1, n1 + n2 + 1), n1)]
    for u in range(n1 * n2 + 1):
        upper = max(u, n1 * n2 - u)
        expected = min(1.0, 2 * sum(x >= upper for x in us) / len(us))
        assert tails.mann_whitney_p(u, n1, n2, 0) == pytest.approx(expected)
    # With ties the normal approximation with continuity and tie correction is used.
    z = (30 - 25 / 2 - 0.5) / math.sqrt(25 / 12 * (11 - 6 / 90))
    assert tails.mann_whitney_p(30, 5, 5, 6) == pytest.approx(2 * (1 - NormalDist().cdf(z)))


def test_kendall_exact_by_enumeration():
    n = 5
    perms = list(itertools.permutations(range(n)))
    counts = [sum(p[i] > p[j] for i in range(n) for j in range(i + 1, n)) for p in perms]
    none = (0, 0, 0)
    for d in range(11):
        fewest = min(d, 10 - d)
        expected = min(1.0, 2 * sum(c <= fewest for c in counts) / len(perms))
        assert tails.kendall_p(10 - d, d, n, none, none) == pytest.approx(expected)


def test_small_samples():
    assert tails.correlation_p(1.0, 2) == 1.0
    assert tails.correlation_p(None, 10) is None
    assert tails.shapiro_p(1.0, 3) == pytest.approx(1.0)
