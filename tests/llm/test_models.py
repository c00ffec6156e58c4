"""Shard capacities and fitted models against their definitions."""

import numpy as np
import pytest

from cardwatch.llm import quality, sharding, toxicity


@pytest.mark.parametrize("seed", range(6))
def test_capacity_is_the_smallest_of_all_contiguous_cuts(seed):
    rng = np.random.default_rng(seed)
    sizes = [int(s) for s in (rng.integers(1, 40, 60) if seed % 2 else rng.pareto(1, 60) * 10 + 1)]
    n, before = len(sizes), np.concatenate([[0], np.cumsum(sizes)])
    items = sharding.Blocks(range(n), [64] * n, sizes, [True] * n, [False] * n)
    best = before[1:].astype(float)  # of the first i items in one shard
    for shards in range(2, 9):
        best = np.array([min([before[i], *(max(best[k - 1], before[i] - before[k]) for k in range(1, i))]) for i in range(1, n + 1)])
        capacity = items.smallest(shards, False)
        fits, cuts = items.greedy(capacity, shards, False)
        assert capacity == best[-1] and fits and max(np.diff([0, *cuts])) == capacity
        assert not items.greedy(capacity - 1, shards, False)[0]


@pytest.mark.parametrize("step", [2**45, 2**53])
def test_refined_blocks_reach_the_smallest_capacity(spark, step):
    sizes = np.random.default_rng(7).integers(1, 4, 2000)
    keys = [-2**63 + i * step for i in range(len(sizes))]
    groups = spark.createDataFrame([(h, int(s)) for h, s in zip(keys, sizes)], "h long, bytes long")
    named, starts = sharding.plan_cuts(groups, 3)
    shard = np.searchsorted(np.array(starts), np.array(keys), "right")
    before = np.concatenate([[0], np.cumsum(sizes)])
    first, second = before[:, None], before[None, :]
    every_cut = np.where(first <= second, np.maximum(np.maximum(first, second - first), before[-1] - second), before[-1])
    assert not named and np.bincount(shard, sizes, 3).max() == every_cut.min()


def plain_loss(x, grade, weight, w, theta):
    """Weighted negative log-likelihood of P(grade <= k) = 1 / (1 + exp(x w - theta_k))."""
    total = 0.0
    for row, g, share in zip(x, grade, weight / weight.sum()):
        upto = [0.0, *(1 / (1 + np.exp(row @ w - t)) for t in theta), 1.0]
        total -= share * np.log(upto[g + 1] - upto[g])
    return total


def slope(f, point, i, width=1e-5):
    high, low = point.copy(), point.copy()
    high[i] += width
    low[i] -= width
    return (f(high) - f(low)) / (2 * width)


def test_ordinal_fit_is_the_minimum_of_the_penalised_likelihood():
    rng = np.random.default_rng(11)
    n, width, penalty = 240, 6, 0.01
    x = rng.poisson(0.7, (n, width)).astype(float)
    hidden = x @ np.array([1.5, -1.0, 0.8, 0.0, 0.0, 0.05]) + rng.logistic(size=n)
    grade, weight = np.digitize(hidden, [0.5, 2.0]), rng.uniform(0.5, 2, n)
    rows, cols = np.nonzero(x)
    w, theta = toxicity.fit_ordinal(
        toxicity.Matrix(rows, cols, x[rows, cols], x.shape), grade, weight, 3, penalty=penalty, steps=5000)
    assert theta[0] < theta[1] and (w == 0).any() and w[0] > 0 > w[1]
    for k in range(2):
        assert abs(slope(lambda t: plain_loss(x, grade, weight, w, t), theta, k)) < 1e-5
    for j in range(width):
        s = slope(lambda v: plain_loss(x, grade, weight, v, theta), w, j)
        assert abs(s + penalty * np.sign(w[j])) < 1e-5 if w[j] else abs(s) <= penalty + 1e-5


def rows_of(n, seed):
    rng = np.random.default_rng(seed)
    return [(int(rng.random() < 0.4), np.unique(rng.integers(0, 40, rng.integers(0, 12))),
             rng.normal(size=quality.STATISTICS)) for _ in range(n)]


def pairs(fm, cols, x):
    out = fm.bias + sum(fm.weights[c] * v for c, v in zip(cols, x))
    for i in range(len(cols)):
        for j in range(i):
            out += (fm.factors[cols[i]] @ fm.factors[cols[j]]) * x[i] * x[j]
    return out


def test_linear_time_margin_is_the_sum_over_pairs(monkeypatch):
    monkeypatch.setattr(quality, "PASSES", 2)
    rows = rows_of(50, 3)
    fm = quality.train(rows)
    fm.factors = fm.factors.astype(float) * 20  # so that the pairs weigh as much as the rest
    for _, words, stats in rows:
        cols, x = fm.columns(words, stats)
        assert fm.margin(cols, x) == pytest.approx(pairs(fm, cols, x), rel=1e-9, abs=1e-9)


def test_a_step_of_the_fit_follows_the_numeric_gradient(monkeypatch):
    rows = rows_of(12, 4)
    monkeypatch.setattr(quality, "PASSES", 0)
    start = quality.train(rows)
    monkeypatch.setattr(quality, "PASSES", 1)
    after = quality.train(rows)
    start.weights, start.factors = start.weights.astype(float), start.factors.astype(float)
    data = [start.columns(w, s) for _, w, s in rows]

    def loss():
        return np.mean([np.log1p(np.exp((1 - 2 * y) * pairs(start, *d))) for (y, *_), d in zip(rows, data)])

    def moved(table, at):
        kept, found = table[at], []
        for change in (1e-4, -1e-4):
            table[at] = kept + change
            found.append(loss())
        table[at] = kept
        g = (found[0] - found[1]) / 2e-4 + quality.RIDGE * kept
        return -quality.RATE * g / np.sqrt(g * g + 1e-4)

    used = np.unique(np.concatenate([d[0] for d in data]))
    for c in [*used[:4], *used[-4:]]:
        assert after.weights[c] - start.weights[c] == pytest.approx(moved(start.weights, c), rel=1e-3, abs=1e-7)
        for f in (0, quality.RANK - 1):
            assert after.factors[c, f] - start.factors[c, f] == pytest.approx(moved(start.factors, (c, f)), rel=1e-3, abs=1e-7)
    untouched = np.setdiff1d(np.arange(len(after.weights)), used)
    assert not after.weights[untouched].any() and (after.factors[untouched] == start.factors[untouched]).all()
