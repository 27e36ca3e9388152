"""ConsistencyLoss and CheckerboardLoss in closed form."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pairloom.functions import spectral
from pairloom.plans.catalog import QUERIES

RNG = np.random.default_rng(7)


def test_checkerboard_takes_all_pairs():
    a, b = RNG.random((2, 3, 8, 8))
    total, n = 0.0, 0
    for c in range(3):
        for y in (0, 4):
            for x in (0, 4):
                p, q = (v[c, y : y + 4, x : x + 4].ravel() for v in (a, b))
                for i in range(16):
                    for j in range(i + 1, 16):
                        total += math.sqrt(((p[i] - p[j]) - (q[i] - q[j])) ** 2 + 1e-12)
                        n += 1
    assert spectral.checkerboard(a, b) == pytest.approx(total / n)
    assert spectral.checkerboard(a, a + 0.1) == pytest.approx(1e-6)
    one = np.zeros((1, 4, 4))
    one[0, 0, 0] = 0.5
    assert spectral.checkerboard(one, np.zeros((1, 4, 4))) == pytest.approx(0.5 * 15 / 120, abs=1e-5)
    with pytest.raises(ValueError):
        spectral.checkerboard(a[:, :7], b[:, :7])


def grays(level):
    return np.full((3, 16, 16), level)


def test_consistency_of_grays():
    """Gray has no chroma, so that term is the clip's lower bound; white has L* 1, and the target's counts 0.9."""
    assert spectral.lightness(grays(1.0)) == pytest.approx(1) and spectral.oklab_chroma(grays(1.0)) == pytest.approx(0, abs=1e-6)
    assert spectral.consistency(grays(1.0), grays(1.0)) == pytest.approx(0.25 * (0.1 + 1 / 255), abs=1e-6)
    y = ((0.5 + 0.055) / 1.055) ** 2.4
    light = (116 * y ** (1 / 3) - 16) / 100
    assert spectral.consistency(grays(1.0), grays(0.5)) == pytest.approx(0.25 * (1 - 0.9 * light + 1 / 255), abs=1e-6)


def test_consistency_of_colours():
    """Pure red against white: Oklab of red is (0.6280, 0.2249, 0.1258), L* is 53.24."""
    red = grays(1 / 255)
    red[0] = 1
    a, b = spectral.oklab_chroma(np.stack([np.ones((1, 1)), *np.zeros((2, 1, 1))]))[:, 0, 0]
    assert (a, b) == pytest.approx((0.2249, 0.1258), abs=2e-3)
    a, b = spectral.oklab_chroma(red)[:, 0, 0]
    light = spectral.lightness(red)[0, 0]
    assert light == pytest.approx(0.5324, abs=2e-3)
    x, y = np.array([a + 0.5, b + 0.5]), np.array([0.5, 0.5])
    apart = 1 - x @ y / math.sqrt((x @ x) * (y @ y))
    chroma = np.clip(np.abs(x - y) + 0.012 * apart, 1 / 255, 254 / 255).mean()
    want = 0.25 * (0.9 - light + chroma + 0.5 * apart)
    assert spectral.consistency(red, grays(1.0)) == pytest.approx(want, abs=1e-5)
    with pytest.raises(ValueError):
        spectral.consistency(red[:1], red[:1])


@pytest.mark.parametrize("name", ["ConsistencyLoss", "CheckerboardLoss"])
def test_queries_see_rgb(spark, sf, name):
    values = [r.value for r in QUERIES[name](spark, sf).collect()]
    assert values and all(math.isfinite(v) and v > 0 for v in values)
