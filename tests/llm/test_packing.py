"""The packing plan: its columns, its bound and its places."""

import itertools
from collections import Counter

import numpy as np
import pytest

from gaugewell.llm import packing


def histogram(name):
    rng = np.random.default_rng(3)
    return Counter(
        {
            "even": rng.integers(1, 64, 5000),
            "large": rng.integers(33, 64, 500),
            "thirds": rng.integers(22, 31, 700),
            "few": np.array([60, 60, 60, 3]),
            "gaps": np.concatenate([np.full(300, 31), np.full(40, 7)]),
            "one": np.array([5]),
            "none": np.zeros(0, int),
        }[name].tolist()
    )


@pytest.mark.parametrize("name", ["even", "large", "thirds", "few", "gaps", "one", "none"])
@pytest.mark.parametrize("slack", [0, 2, 40])
def test_every_token_has_one_place_and_no_place_is_unused(name, slack):
    counts = histogram(name) | {64: 5}
    plan = packing.plan_packing(counts, 64, slack)
    used = Counter()
    for length, n in counts.items():
        for rank in range(n):
            parts = plan.place(length, rank)
            assert [p[0] for p in parts] == list(itertools.accumulate([p[1] for p in parts], initial=0))[:-1]
            assert sum(p[1] for p in parts) == length
            used.update((s, o + i) for _, k, s, o in parts for i in range(k))
    assert set(used.values()) == {1}
    sizes = Counter(s for s, _ in used)
    assert all((s, i) in used for s, n in sizes.items() for i in range(n))
    short = [n for _, n in sorted(sizes.items()) if n < 64]
    assert all(n & (n - 1) == 0 for n in short) and len(short) == len(set(short)) <= 6


def test_nearly_all_of_many_documents_stay_whole():
    lengths = np.random.default_rng(4).lognormal(6, 0.9, 10_000).astype(int) % 2048
    plan = packing.plan_packing(Counter(lengths.tolist()))
    assert sum(plan.dealt.values()) > 9_900 and plan.pool_tokens < 20 * 2048


def test_full_patterns_leave_no_full_pattern():
    rng = np.random.default_rng(5)
    for _ in range(60):
        lengths = np.array(sorted(rng.choice(np.arange(1, 20), rng.integers(1, 6), replace=False)))
        demand = rng.integers(1, 4, len(lengths))
        patterns, left = packing.full_patterns(lengths, demand, 20)
        taken = np.zeros(len(lengths), int)
        for column, times in patterns:
            assert sum(int(lengths[i]) * n for i, n in column) == 20
            for i, n in column:
                taken[i] += n * times
        assert (taken + left == demand).all()
        sums = {int(np.dot(c, lengths)) for c in itertools.product(*(range(n + 1) for n in left))}
        assert 20 not in sums


@pytest.mark.parametrize("lengths, size", [([34, 35, 41, 60], 100), ([10, 23, 27, 30], 64), ([5, 7, 11, 13], 31)])
def test_priced_patterns_reach_the_bound(lengths, size):
    lengths, demand = np.array(lengths), np.array([97.0, 61, 40, 5])
    columns, x, least = packing.solve(lengths, demand, size)
    assert np.allclose(columns @ x, demand) and (lengths @ columns <= size).all() and (x >= 0).all()
    assert least <= x.sum() + 1e-9 <= least * (1 + 1e-4) + 1e-6
    # fewer than by patterns of one length each
    assert x.sum() < (demand / (size // lengths)).sum()
    assert x.sum() >= (lengths * demand).sum() / size - 1e-9


def test_pricing_finds_the_best_pattern():
    rng = np.random.default_rng(6)
    for _ in range(30):
        lengths, duals = np.array([5, 7, 11, 13]), rng.random(4)
        value, column = packing._price(lengths, duals, 31)
        fits = [c for c in itertools.product(*(range(31 // k + 1) for k in lengths)) if np.dot(c, lengths) <= 31]
        assert np.isclose(value, max(np.dot(c, duals) for c in fits)) and np.isclose(column @ duals, value)
        assert column @ lengths <= 31
