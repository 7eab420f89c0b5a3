"""Recall of op1's cells at the cosine limit for vectors of several dimensions."""

import numpy as np
import pytest

from kinetable.llm import lattice


@pytest.mark.parametrize("dim", [8, 16, 24, 32, 64, 128])
def test_pairs_at_the_limit_meet(dim):
    rng = np.random.default_rng(dim)
    a, noise = rng.normal(size=(2, 2000, dim))
    a /= np.linalg.norm(a, axis=1)[:, None]
    noise -= (noise * a).sum(1)[:, None] * a
    b = lattice.COSINE * a + np.sqrt(1 - lattice.COSINE**2) * noise / np.linalg.norm(noise, axis=1)[:, None]
    (home_a, near_a), (home_b, near_b) = lattice.cells(a), lattice.cells(b)
    met = (home_a == home_b) | (near_a == home_b[:, :, None]).any(2) | (near_b == home_a[:, :, None]).any(2)
    assert met.any(1).mean() >= 0.998
