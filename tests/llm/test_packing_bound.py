"""The number of sequences against the exact optimum of the configuration program, by column generation."""

import numpy as np
import pytest

from quarry.llm.best_fit_packing import pack_histogram


def program_optimum(counts, capacity):
    """Least sum of configurations that covers the counts: a primal simplex whose entering column is the dearest
    sequence under the current prices (unbounded knapsack, one capacity after the other)."""
    lengths = np.flatnonzero(counts)
    m = len(lengths)
    basis = np.diag([float(capacity // n) for n in lengths])
    x = counts[lengths] / np.diag(basis)
    while True:
        price = np.linalg.solve(basis.T, np.ones(m))
        value, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for c in range(1, capacity + 1):
            value[c] = value[c - 1]
            fit = np.flatnonzero(lengths <= c)
            if len(fit):
                got = value[c - lengths[fit]] + price[fit]
                j = int(got.argmax())
                if got[j] > value[c] + 1e-12:
                    value[c], last[c] = got[j], fit[j]
        if value[capacity] <= 1 + 1e-9:
            return x.sum()
        column, c = np.zeros(m), capacity
        while c > 0:
            if last[c] < 0:
                c -= 1
                continue
            column[last[c]] += 1
            c -= lengths[last[c]]
        d = np.linalg.solve(basis, column)
        ratio = np.where(d > 1e-12, x / np.where(d > 1e-12, d, 1), np.inf)
        k = int(ratio.argmin())
        x = x - ratio[k] * d
        x[k] = ratio[k]
        basis[:, k] = column


@pytest.mark.parametrize("low,high", [(25, 88), (33, 65), (5, 60), (44, 63)])
def test_sequences_are_near_the_optimum_of_the_program(low, high):
    rng = np.random.default_rng(low)
    counts = np.zeros(129, np.int64)
    counts[low:high] = rng.integers(50, 400, high - low)
    plan = pack_histogram(counts, 128)
    assert (sum(n * a for a, n in zip(plan.configs, plan.copies)) == counts).all()
    best = program_optimum(counts, 128)
    assert best - 1e-6 <= plan.sequences <= 1.02 * best, (plan.sequences, best)
