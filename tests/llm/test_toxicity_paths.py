"""The decoder's output against the cheapest of all paths through the lattice."""

import itertools
import random

import numpy as np
import pytest

from strideframe.llm import toxicity as X


def path_cost(costs, path):
    a = b = 0
    total = 0.0
    for channel, symbols, _ in path:
        total += channel
        for s in symbols:
            if s or b:              # several breaks in a row count once
                total += costs[a][b][s]
                a, b = b, s
    return total + (costs[a][b][0] if b else 0.0)


@pytest.mark.parametrize("seed", range(4))
def test_output_is_the_cheapest_path(seed):
    rnd = random.Random(seed)
    counts = np.random.default_rng(seed).integers(0, 40, (X.SYMBOLS,) * 3).astype(float)
    decode = X.Decoder(X.log_costs(counts))
    signs = "".join(X.LEET) + "abst. -é"
    tried = changed = 0
    while tried < 60:
        span = "".join(rnd.choice(signs) * rnd.choice((1, 1, 1, 3)) for _ in range(rnd.randint(1, 7)))
        steps = decode._lattice(span)
        if np.prod([len(o) for o in steps]) > 5_000:
            continue
        tried += 1
        best = {}
        for path in itertools.product(*steps):
            out = "".join(o[2] for o in path)
            best[out] = min(best.get(out, np.inf), path_cost(decode.costs, path))
        got = decode(span)
        assert best[got] == pytest.approx(min(best.values()), abs=1e-9), span
        changed += got != span
    assert changed > 5


def test_costs_are_probabilities():
    counts = np.random.default_rng(1).integers(0, 9, (X.SYMBOLS,) * 3).astype(float)
    assert np.allclose(np.exp(-X.log_costs(counts)).sum(axis=2), 1.0)
    assert np.allclose(np.exp(-X.log_costs(np.zeros_like(counts))).sum(axis=2), 1.0)
