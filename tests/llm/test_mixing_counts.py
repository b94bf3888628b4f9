"""Counts of a mix beyond the sizes that numpy draws from."""

import math

import numpy as np
import pytest

from driftgate.llm import mixing


def exact(own, others, slots):
    """The probability of each count, by binomial coefficients."""
    low, high = max(0, slots - others), min(own, slots)
    whole = math.comb(own + others, slots)
    return low, np.array([math.comb(own, k) * math.comb(others, slots - k) / whole for k in range(low, high + 1)])


@pytest.mark.parametrize("own, others, slots", [(7, 5, 6), (3, 90, 40), (60, 4, 50), (50, 50, 50), (1, 1, 1), (2, 400, 5)])
def test_same_law_as_the_coefficients(monkeypatch, own, others, slots):
    monkeypatch.setattr(mixing, "_NUMPY", 0)
    rng = np.random.default_rng([own, others, slots])
    n = 20_000
    drawn = np.array([mixing._hypergeometric(own, others, slots, rng) for _ in range(n)])
    low, p = exact(own, others, slots)
    assert drawn.min() >= low and drawn.max() <= low + len(p) - 1
    seen = np.bincount(drawn - low, minlength=len(p)) / n
    assert np.abs(seen - p).max() < 4.5 * np.sqrt((p * (1 - p)).max() / n) + 1e-9


@pytest.mark.parametrize("own, others, slots", [(4 * 10**11, 6 * 10**11, 5 * 10**11), (10**12, 3, 10**11), (40, 10**12, 5 * 10**11)])
def test_huge_counts(own, others, slots):
    rng = np.random.default_rng(5)
    rest = own + others
    drawn = np.array([mixing._hypergeometric(own, others, slots, rng) for _ in range(40)], float)
    assert drawn.min() >= max(0, slots - others) and drawn.max() <= min(own, slots)
    mean = slots * (own / rest)
    spread = (mean * (others / rest) * ((rest - slots) / (rest - 1))) ** 0.5
    assert abs(drawn.mean() - mean) <= 4 * spread / 40**0.5 + 1e-3 * (spread < 1) + 1e-9
    if spread > 1:
        assert 0.6 < drawn.std() / spread < 1.5


def test_shards_add_up_to_the_draws():
    draws = np.array([3_000_000_000, 17, 1_000_000_001, 0, 40])
    shards = -(-int(draws.sum()) // mixing.SLOTS)
    mix = mixing.Mix([None] * 5, draws, draws.astype(float), draws, draws, draws, 1)
    held: dict = {}
    counts, before = mixing.shard_counts(mix, shards - 1, shards, held)
    assert (counts + before == draws).all() and 0 < counts.sum() <= mixing.SLOTS
    counts, before = mixing.shard_counts(mix, 0, shards, held)
    assert counts.sum() == mixing.SLOTS and not before.any()
